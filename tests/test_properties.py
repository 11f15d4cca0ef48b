"""Property tests (hypothesis): distributed operators equal their single-task definitions."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from tallyhouse.functions.fingerprint import fingerprint_agg
from tallyhouse.operators.dedup import keep_first
from tallyhouse.operators.ntile import ntile

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(values=st.lists(st.integers(0, 20), max_size=60),
       buckets=st.integers(1, 9), parts=st.integers(1, 6))
def test_ntile_equals_window(spark, values, buckets, parts):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v int")
    expected = {r.id: r.b for r in df.select(
        "id", F.ntile(buckets).over(Window.orderBy("v", "id")).alias("b")).collect()}
    got = {r.id: r.b for r in ntile(df, buckets, ["v", "id"], out="b", partitions=parts).collect()}
    assert got == expected


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 5), st.integers(0, 10**6), st.text(max_size=3)),
                     max_size=60),
       parts=st.integers(1, 5))
def test_keep_first_equals_row_number(spark, rows, parts):
    df = spark.createDataFrame([(k, a, b, i) for i, (k, a, b) in enumerate(rows)],
                               "k int, a long, b string, pos int")
    w = Window.partitionBy("k").orderBy("pos")
    expected = sorted(tuple(r) for r in df.withColumn("rn", F.row_number().over(w))
                      .filter("rn = 1").select("k", "a", "b").collect())
    got = sorted(tuple(r) for r in keep_first(df.repartition(parts), ["k"], ["pos"], ["a", "b"]).collect())
    assert got == expected


@SETTINGS
@given(rows=st.lists(st.tuples(st.text(max_size=4), st.one_of(st.none(), st.text(max_size=4))),
                     max_size=40),
       parts=st.integers(1, 5), seed=st.integers(0, 1000))
def test_fingerprint_invariant_under_reorder(spark, rows, parts, seed):
    df = spark.createDataFrame(rows, "a string, b string")
    one = df.agg(fingerprint_agg("a", "b")).first()[0]
    two = df.repartition(parts).orderBy(F.rand(seed)).agg(fingerprint_agg("a", "b")).first()[0]
    assert one == two
