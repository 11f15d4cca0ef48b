import zlib

import pytest

from tallyhouse.llm import sharding
from tests.llm.docs import SCHEMA, awkward


@pytest.mark.parametrize("n", [1, 2, 3, 5, 12, 100, 1237])
def test_positions_are_a_permutation(n):
    assert sorted(sharding.position_of(i, n, 3) for i in range(n)) == list(range(n))


def test_columns_follow_the_law_without_data(spark):
    df = spark.range(1000).withColumnRenamed("id", "doc_id").repartition(5)
    rows = sharding.shard(df, 7, seed=9).collect()
    assert {(r.doc_id, r.row_no) for r in rows} == {(i, i) for i in range(1000)}
    for r in rows:
        p = sharding.position_of(r.row_no, 1000, 9)
        assert (r.position, r.shard, r.slot) == (p, p % 7, p // 7)


def test_awkward_rows(spark):
    out = sharding.digest(awkward(spark, extra="n_chars")).collect()
    assert len(out) == 14
    counts = [sum(r.shard == s for r in out) for s in range(8)]
    assert max(counts) - min(counts) <= 1
    for s in range(8):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(counts[s]))
    null = next(r for r in out if r.doc_id == 2)
    assert (null["size"], null.text_crc32, null.law, null.grown_shard) == (1, 0, "rows", None)
    seven = next(r for r in out if r.doc_id == 7)
    raw = "é ü ñ 😀 x y".encode()
    assert (seven["size"], seven.text_crc32) == (len(raw) + 1, zlib.crc32(raw))


def test_empty_and_clashing(spark):
    assert sharding.digest(spark.createDataFrame([], SCHEMA)).collect() == []
    df = awkward(spark, extra="slot rest")
    out = sharding.shard(df)
    assert out.columns == [*df.drop("slot").columns, "row_no", "position", "shard", "slot"]
    assert out.filter("rest = 1").count() == 14 and out.agg({"slot": "max"}).first()[0] == 1


def test_reruns_agree(spark):
    a = sharding.digest(awkward(spark)).collect()
    b = sharding.digest(awkward(spark).repartition(5)).collect()
    key = lambda r: str(tuple(r))
    assert sorted(map(key, a)) == sorted(map(key, b))


def test_write_shards(spark, tmp_path):
    df = sharding.shard(awkward(spark), 4)
    sharding.write_shards(df, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 14 and back.select("shard").distinct().count() == 4
