"""Every stage against a brute-force version on its own input."""

import re
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as P  # noqa: E402
from tallyhouse.llm import toxicity  # noqa: E402
from tallyhouse.llm.common import staged  # noqa: E402
from tests.llm import test_decontaminate, test_mixing, test_ngram_join  # noqa: E402
from tests.llm.docs import SCHEMA, awkward  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(staged(stage(spark, out[-1], SF), f"test_{name}"))
    return out


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def test_columns(steps):
    for a, b in zip(steps[:-2], steps[1:-1]):
        assert a.columns == b.columns
    assert steps[-1].columns == [*steps[0].columns, "row_no", "position", "shard", "slot"]


def test_toxicity(spark, steps):
    docs, labels = steps[0], spark.read.parquet(f"{SF}/labels.parquet")
    bad = {r.doc_id for r in toxicity.digest(docs, labels).collect() if r.predicted}
    assert {r["doc_id"] for r in rows_of(steps[1])} == {r["doc_id"] for r in rows_of(docs)} - bad


def test_near_copies(steps):
    docs = [(r["doc_id"], r["text"]) for r in rows_of(steps[1])]
    want = {d for d, _, c in test_ngram_join.brute(docs) if d == c}
    assert sorted(r["doc_id"] for r in rows_of(steps[2])) == sorted(want)


def test_decontamination(spark, steps):
    docs = [(r["doc_id"], r["text"]) for r in rows_of(steps[2])]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {d for d, _ in test_decontaminate.brute(docs, items)}
    assert {r["doc_id"] for r in rows_of(steps[3])} == {d for d, _ in docs} - bad and bad


def test_mixing_and_sharding(steps):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    before, after = rows_of(steps[3]), rows_of(steps[4])
    size, got = Counter(), Counter()
    for r in before:
        size[r["source"]] += words(r["text"])
    for r in after:
        got[r["source"]] += words(r["text"])
    for s, t in test_mixing.brute_targets(size).items():
        mine = sorted(words(r["text"]) for r in before if r["source"] == s)
        assert abs(got[s] - t) <= max(mine[len(mine) // 2], 0.001 * t)
    times = Counter(r["doc_id"] for r in after)
    assert max(times.values()) <= 3 and set(times) <= {r["doc_id"] for r in before}
    final = rows_of(steps[5])
    assert Counter(r["doc_id"] for r in final) == times
    for s in range(8):
        slots = sorted(r["slot"] for r in final if r["shard"] == s)
        assert slots == list(range(len(slots))) and abs(len(slots) - len(final) / 8) <= 1


def test_layout_does_not_change_the_shuffle(spark):
    """Repeated and null doc_ids: every row has the same place whatever the layout of the input."""
    rows = [(None if i % 20 == 0 else i % 20, f"text {i // 20} of {i % 20}", "en", f"s{i % 3}") for i in range(400)]
    places = [sorted(map(str, P.shard(spark, spark.createDataFrame(sorted(rows, key=lambda r: hash((r, k))), SCHEMA).repartition(k), SF)
                         .select("text", "shard", "slot").collect())) for k in (2, 7)]
    assert places[0] == places[1]


@pytest.mark.parametrize("k", range(5))
def test_awkward_rows_and_names(spark, k):
    df = awkward(spark, extra="score predicted _rid _first _text size copies rest slot")
    out = P.STAGES[k][1](spark, df, SF)
    assert (out.columns == df.columns) if k < 4 else set(df.columns) <= set(out.columns)
    assert 0 < out.count() <= 3 * 14 and out.filter("rest <> 1 or _rid <> 1 or score <> 1").count() == 0
    empty = P.STAGES[k][1](spark, spark.createDataFrame([], SCHEMA), SF)
    assert empty.collect() == []
