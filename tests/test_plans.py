"""Physical-plan properties the design relies on at scale."""

import datetime as dt

import pytest

from tallyhouse.plans import marts as M
from tallyhouse.plans import queries as Q
from tallyhouse.plans import refresh as R
from tallyhouse.plans import staging as S
from tallyhouse.plans.layers import feeds_from_tables, layers_from_tables
from tallyhouse.session import fresh_scratch_path
from tallyhouse.sources import testfeeds
from tests.conftest import SMALL


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def published(spark):
    root = fresh_scratch_path(spark, "wh")
    R.run_refresh(spark, feeds_from_tables(spark, SMALL), root, dt.datetime(2025, 6, 1))
    return R.published_marts(spark, root)


def test_keep_first_combines_before_the_shuffle(spark):
    raw = S.land_rates(testfeeds.unemployment_feed(spark, SMALL), "2025-01-01 00:00:00")
    plan = planned(S.stage_rates(raw, "unemployment_rate"))
    partial = plan.find("partial_min_by")
    exchange = plan.find("Exchange hashpartitioning(iso_code")
    assert partial > exchange > 0          # printed top-down: partial sits below the exchange


def test_latest_year_is_a_partition_filter_and_top_k(published):
    plan = executed(Q.q03(published))
    assert "TakeOrderedAndProject" in plan
    assert "PartitionFilters: [isnotnull(year" in plan and "Subquery" in plan


def test_country_filter_pushed_to_scan(published):
    plan = executed(Q.q04(published, "NAA"))
    assert "EqualTo(iso_code,NAA)" in plan


def test_no_hints_and_no_fixed_exchanges(spark):
    L = layers_from_tables(spark, SMALL)
    for df in (L.fact, L.with_population, L.raw_unemployment, L.raw_population):
        plan = df._jdf.queryExecution()
        assert "strategy=" not in plan.analyzed().toString()
        assert "REPARTITION_BY_NUM" not in plan.executedPlan().toString()


def test_staging_filter_reaches_the_scan(spark):
    path = fresh_scratch_path(spark, "raw")
    testfeeds.employment_feed(spark, SMALL).write.parquet(path)
    plan = planned(S.stage_rates(spark.read.parquet(path), "employment_rate"))
    assert "In(sex, [Female,Male,Total])" in plan and "In(age, [15+,15-24,25+])" in plan


def test_hot_key_join_is_split(spark):
    """With a third of all orders on one customer, AQE splits the join's hot partition."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    from pyspark.sql import functions as F
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        root = fresh_scratch_path(spark, "hot")
        for t in ("orders", "customer", "nation"):
            df = spark.read.parquet(f"{SMALL}/{t}.parquet")
            if t == "orders":
                df = df.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("o_custkey")))
            df.repartition(8).write.parquet(f"{root}/{t}.parquet")
        keys = testfeeds.order_keys(spark, root)
        keys.write.format("noop").mode("overwrite").save()
        plan = executed(keys)
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(Q.CATALOGUE))
def test_registered_queries_read_marts_only(spark, name):
    import __spark_entry__ as E
    plan = executed(E.warehouse_queries()[name](spark, SMALL))
    assert "lineitem" not in plan and "orders" not in plan


def test_fingerprint_is_observed_in_the_write_stage(spark):
    from pyspark.sql import Observation, functions as F
    from tallyhouse.functions.fingerprint import fingerprint_agg
    raw = S.land_rates(testfeeds.employment_feed(spark, SMALL), "2025-01-01 00:00:00")
    obs = Observation("t")
    observed = raw.observe(obs, F.count(F.lit(1)).alias("rows"),
                           fingerprint_agg("iso_code", "country").alias("fp"))
    plan = planned(observed)
    # no exchange above the observation: metrics come from the final (result) stage
    assert plan.find("CollectMetrics") < plan.find("Exchange")
