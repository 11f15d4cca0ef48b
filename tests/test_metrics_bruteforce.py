"""Derived metrics against exact decimal arithmetic with one half-up rounding."""

from decimal import ROUND_HALF_UP, Decimal, localcontext

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tallyhouse.functions.metrics import persons_estimate, rate_gap, rate_ratio

rates = st.integers(0, 100_000).map(lambda k: Decimal(k) / 1000)


def exact(u, e, p):
    with localcontext() as ctx:
        ctx.prec = 60
        ratio = None if e == 0 else (u / e).quantize(Decimal("0.000001"), ROUND_HALF_UP)
        persons = (Decimal(p) * u / 100).quantize(Decimal("0.01"), ROUND_HALF_UP)
    return ratio, (u - e).quantize(Decimal("0.001")), persons


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(rates, rates, st.integers(1, 10**10)), min_size=1, max_size=200))
def test_metrics_exact(spark, rows):
    df = spark.createDataFrame(rows, "u decimal(10,3), e decimal(10,3), p long")
    out = df.select("u", "e", "p", rate_ratio("u", "e").alias("r"), rate_gap("u", "e").alias("g"),
                    persons_estimate(F.col("p"), F.col("u")).alias("n")).collect()
    for r in out:
        assert (r.r, r.g, r.n) == exact(r.u, r.e, r.p)


def test_ratio_midpoints(spark):
    # quotients exactly on a 6-decimal midpoint round up; just below stays down
    rows = [(Decimal("0.001"), Decimal("16.000")), (Decimal("1.000"), Decimal("0.008")),
            (Decimal("99.999"), Decimal("0.001")), (Decimal("0.001"), Decimal("100.000"))]
    df = spark.createDataFrame(rows, "u decimal(10,3), e decimal(10,3)")
    for r in df.select("u", "e", rate_ratio("u", "e").alias("r")).collect():
        assert r.r == exact(r.u, r.e, 1)[0]
