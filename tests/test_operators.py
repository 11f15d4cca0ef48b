"""keep-first / keep-last, upserts, ntile, fingerprints, audit classification."""

import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Window, functions as F

from tallyhouse.functions.fingerprint import fingerprint_agg
from tallyhouse.operators import audit as A
from tallyhouse.operators.dedup import keep_first, keep_last
from tallyhouse.operators.ntile import ntile
from tallyhouse.operators.upsert import insert_ignore, upsert, upsert_ordered


def _random_rows(n, keys, seed):
    rnd = random.Random(seed)
    return [(rnd.randrange(keys), rnd.randrange(1_000_000), f"v{rnd.randrange(100)}", i)
            for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_keep_first_equals_row_number(spark, seed):
    df = spark.createDataFrame(_random_rows(3000, 50, seed), "k int, a long, b string, pos long")
    w = Window.partitionBy("k").orderBy("pos")
    expected = sorted(tuple(r) for r in df.withColumn("rn", F.row_number().over(w))
                      .filter("rn = 1").select("k", "a", "b").collect())
    got = sorted(tuple(r) for r in keep_first(df.repartition(7), ["k"], ["pos"], ["a", "b"]).collect())
    assert got == expected
    wl = Window.partitionBy("k").orderBy(F.col("pos").desc())
    expected_last = sorted(tuple(r) for r in df.withColumn("rn", F.row_number().over(wl))
                           .filter("rn = 1").select("k", "a", "b").collect())
    got_last = sorted(tuple(r) for r in keep_last(df, ["k"], ["pos"], ["a", "b"]).collect())
    assert got_last == expected_last


def test_keep_first_hot_key(spark):
    # one key holding most rows: still one row out, the earliest
    rows = [(0, i, "hot", i) for i in range(5000)] + [(1, 7, "cold", 9999)]
    df = spark.createDataFrame(rows, "k int, a long, b string, pos long").repartition(8)
    got = sorted(tuple(r) for r in keep_first(df, ["k"], ["pos"], ["a", "b"]).collect())
    assert got == [(0, 0, "hot"), (1, 7, "cold")]


@pytest.mark.parametrize("n", [0, 1, 3, 4, 6, 97])
@pytest.mark.parametrize("buckets", [4, 5])
def test_ntile_matches_window(spark, n, buckets):
    rnd = random.Random(n)
    rows = [(i, rnd.randrange(30)) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, v int")
    w = Window.orderBy("v", "id")
    expected = sorted(tuple(r) for r in df.select("id", F.ntile(buckets).over(w).alias("b")).collect())
    got = sorted(tuple(r) for r in ntile(df, buckets, ["v", "id"], out="b", partitions=3)
                 .select("id", "b").collect())
    assert got == expected


def test_ntile_rows_never_meet_in_one_partition(spark):
    df = spark.range(5000).withColumn("v", F.col("id") % 13)
    out = ntile(df, 4, ["v", "id"], partitions=8)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # numbered from one written copy: the only single-partition exchange is over the counts
    assert plan.count("SinglePartition") == 1 and "rangepartitioning" not in plan
    sizes = out.groupBy("ntile").count().collect()
    assert sorted(r["count"] for r in sizes) == [1250] * 4


def test_insert_ignore(spark):
    target = spark.createDataFrame([(1, "t1"), (2, "t2")], "k int, v string")
    source = spark.createDataFrame([(2, "s2", 0), (3, "s3b", 2), (3, "s3a", 1)],
                                   "k int, v string, pos int")
    got = sorted(tuple(r) for r in insert_ignore(target, source, ["k"], ["pos"]).collect())
    assert got == [(1, "t1"), (2, "t2"), (3, "s3a")]


def test_upsert_updates_only_listed_columns(spark):
    target = spark.createDataFrame([(1, "c1", 10), (2, "c2", 20)], "k int, c string, v int")
    source = spark.createDataFrame([(2, "new", 21), (3, "c3", 30)], "k int, c string, v int")
    got = sorted(tuple(r) for r in upsert(target, source, ["k"], ["v"]).collect())
    assert got == [(1, "c1", 10), (2, "c2", 21), (3, "c3", 30)]


def test_upsert_duplicate_source_key_fails(spark):
    target = spark.createDataFrame([(1, 10)], "k int, v int")
    source = spark.createDataFrame([(2, 1), (2, 2)], "k int, v int")
    with pytest.raises((PySparkException, Py4JJavaError)):
        upsert(target, source, ["k"], ["v"]).collect()
    for update in (["v"], []):       # no pruning removes the check
        with pytest.raises((PySparkException, Py4JJavaError)):
            upsert(target, source, ["k"], update).count()


def test_latest_audit_row_is_the_last_published(spark):
    import datetime as dt
    t = dt.datetime(2025, 1, 1)
    rows = [("s", n, n, t, f"r{n}", n) for n in (1, 3, 2)]
    hist = spark.createDataFrame(rows, "source_name string, observed_rows long, observed_fingerprint long, "
                                 "observed_at timestamp_ntz, run_id string, version long")
    assert A.latest_per_source(hist).first().previous_rows == 3
    assert A.latest_per_source(hist.drop("version")).first().previous_rows == 3


def test_upsert_ordered_last_wins(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    source = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k int, v string, pos int")
    got = sorted(tuple(r) for r in upsert_ordered(target, source, ["k"], ["pos"]).collect())
    assert got == [(1, "b"), (2, "c")]


def test_fingerprint_order_free(spark):
    df = spark.createDataFrame([(str(i), f"x{i % 7}") for i in range(500)], "a string, b string")
    one = df.agg(fingerprint_agg("a", "b")).first()[0]
    two = df.repartition(5).orderBy(F.rand(3)).agg(fingerprint_agg("a", "b")).first()[0]
    assert one == two
    empty = df.filter("false").agg(fingerprint_agg("a", "b")).first()[0]
    assert empty == 0


def test_md5_fingerprint_run_b(spark):
    from tallyhouse.plans import staging as S
    from tallyhouse.sources import testfeeds
    from tests.conftest import SMALL
    raw = S.land_rates(testfeeds.employment_feed(spark, SMALL), "2025-01-01 00:00:00")
    snap = A.snapshot(raw, "occupazione_csv", ["iso_code", "country", "sex", "age", "year",
                                               "obs_value"], method="md5").first()
    assert snap.observed_rows == 1500
    assert snap.observed_fingerprint == 650875745688322921


def test_classify_all_cases(spark):
    import datetime as dt
    hist = A.empty_history(spark)
    t0 = dt.datetime(2025, 1, 1)
    types = []
    for i, (rows, fp) in enumerate([(10, 1), (12, 1), (12, 5), (12, 5), (9, 5)]):
        cur = A.observed_snapshot(spark, {"src": (rows, fp)})
        new = A.classify(cur, hist, t0 + dt.timedelta(hours=i))
        r = new.first()
        types.append((r.change_type, r.delta_rows, r.new_rows, r.removed_rows))
        hist = hist.unionByName(new).checkpoint()
    assert types == [("first_load", None, 10, 0), ("row_count_changed", 2, 2, 0),
                     ("content_changed_same_count", 0, 0, 0), ("unchanged", 0, 0, 0),
                     ("row_count_changed", -3, 0, 3)]


def test_ntile_nulls_strings_decimals(spark):
    from decimal import Decimal
    rnd = random.Random(5)
    rows = [(i, None if i % 11 == 0 else f"s{rnd.randrange(40):02d}",
             None if i % 13 == 0 else Decimal(rnd.randrange(10000)) / 100) for i in range(700)]
    df = spark.createDataFrame(rows, "id int, s string, d decimal(10,2)")
    w = Window.orderBy(*[F.col(c).asc_nulls_last() for c in ("s", "d", "id")])
    expected = {r.id: r.b for r in df.select("id", F.ntile(9).over(w).alias("b")).collect()}
    got = {r.id: r.b for r in ntile(df, 9, ["s", "d", "id"], out="b", partitions=6).collect()}
    assert got == expected
