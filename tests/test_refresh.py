"""Full refresh runs: publication, rerun determinism, failures, file inputs."""

import datetime as dt

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyhouse.plans import queries as Q
from tallyhouse.plans import refresh as R
from tallyhouse.plans.layers import feeds_from_tables, layers_from_tables
from tallyhouse.session import fresh_scratch_path
from tallyhouse.sources import files, testfeeds
from tallyhouse.sources.warehouse import Warehouse
from tests.conftest import SMALL

T0 = dt.datetime(2025, 3, 1, 12, 0, 0)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def warehouse(spark):
    root = fresh_scratch_path(spark, "wh")
    first = R.run_refresh(spark, feeds_from_tables(spark, SMALL), root, T0)
    second = R.run_refresh(spark, feeds_from_tables(spark, SMALL), root, T0 + dt.timedelta(days=1))
    return root, first, second


def test_published_marts_equal_lazy_plans(spark, warehouse):
    root, _, _ = warehouse
    lazy = layers_from_tables(spark, SMALL).marts()
    pub = R.published_marts(spark, root)
    for name in ("fact", "total", "population", "with_population"):
        assert rows(getattr(pub, name)) == rows(getattr(lazy, name)), name
    for qn, fn in Q.CATALOGUE.items():
        if qn in Q.COUNTRY_QUERIES:
            assert rows(fn(pub, "NAA")) == rows(fn(lazy, "NAA")), qn
        else:
            assert rows(fn(pub)) == rows(fn(lazy)), qn


def test_metrics_match_fixture_counts(warehouse):
    _, first, second = warehouse
    m = first.metrics
    assert (m["employment_raw"], m["employment_stg"], m["unemployment_raw"], m["unemployment_stg"]) == (1500, 590, 6000, 637)
    assert (m["country_year_sex_age_rates"], m["country_population"]) == (580, 24)
    assert second.metrics == first.metrics


def test_rerun_is_unchanged(spark, warehouse):
    root, first, second = warehouse
    hist = Warehouse(spark, root).audit_history()
    got = {(r.source_name, r.change_type) for r in hist.collect()}
    assert got == {(s, t) for s in ("occupazione_csv", "disoccupazione_csv", "population_api")
                   for t in ("first_load", "unchanged")}
    assert first.snapshots == second.snapshots


def test_failed_run_leaves_previous_published(spark, warehouse):
    root, _, second = warehouse
    feeds = feeds_from_tables(spark, SMALL)
    feeds.population_objects = feeds.population_objects.filter(F.lit(False))
    with pytest.raises(RuntimeError):
        R.run_refresh(spark, feeds, root, T0 + dt.timedelta(days=2))
    wh = Warehouse(spark, root)
    assert wh.current_run() == second.run_id
    assert wh.audit_history().count() == 6
    # rolled back: nothing of the failed run is left on storage
    import os
    folders = {x.removeprefix("run_id=") for x in os.listdir(f"{root}/runs".replace("file:", ""))}
    assert folders == set(wh.published_runs())


def test_failed_retry_leaves_the_published_run(spark):
    """A retry with the same run time that fails after landing changes nothing."""
    root = fresh_scratch_path(spark, "wh")
    first = R.run_refresh(spark, feeds_from_tables(spark, SMALL), root, T0)
    wh = Warehouse(spark, root)
    before = {t: rows(wh.read(layer, t)) for layer, t in R.LAYER_TABLES if "raw" not in t}
    feeds = feeds_from_tables(spark, SMALL)
    feeds.employment = feeds.employment.limit(100)
    feeds.population_objects = feeds.population_objects.filter(F.lit(False))
    with pytest.raises(RuntimeError):
        R.run_refresh(spark, feeds, root, T0)
    assert wh.current_run() == first.run_id and wh.published_runs() == [first.run_id]
    assert {t: rows(wh.read(layer, t)) for layer, t in R.LAYER_TABLES if "raw" not in t} == before
    assert wh.read("ingestion", R.RAW_EMPLOYMENT).count() == first.metrics[R.RAW_EMPLOYMENT]


def test_back_dated_run_becomes_current_and_old_runs_are_freed(spark):
    root = fresh_scratch_path(spark, "wh")
    first = R.run_refresh(spark, feeds_from_tables(spark, SMALL), root, T0)
    second = R.run_refresh(spark, feeds_from_tables(spark, SMALL), root, T0 - dt.timedelta(days=9))
    wh = Warehouse(spark, root)
    assert wh.current_run() == second.run_id
    assert wh.retain(1) == [first.run_id]
    assert R.published_marts(spark, root).fact.count() == 580
    assert wh.audit_history().filter("change_type = 'unchanged'").count() == 3
    with pytest.raises(PySparkException):
        wh.read("mart", R.FACT, first.run_id).count()


def test_existing_tables_are_never_written_again(spark):
    wh = Warehouse(spark, fresh_scratch_path(spark, "wh"))
    df = spark.range(3)
    wh.write(df, "r", "mart", "t")
    with pytest.raises(PySparkException):
        wh.write(df, "r", "mart", "t")


def test_load_times_and_not_null(spark):
    root = fresh_scratch_path(spark, "wh")
    R.run_refresh(spark, feeds_from_tables(spark, SMALL), root, T0)
    wh = Warehouse(spark, root)
    for layer, table in R.LAYER_TABLES:
        df = wh.read(layer, table)
        at = [c for c in df.columns if c.endswith("_at")]
        assert len(at) == 1 and {r[0] for r in df.select(at[0]).distinct().collect()} == {T0}, table
    empty = Warehouse(spark, fresh_scratch_path(spark, "wh"))
    assert empty.audit_history().count() == 0 and empty.published_runs() == []
    with pytest.raises(RuntimeError):
        empty.current_run()


def test_null_key_fails_run(spark):
    root = fresh_scratch_path(spark, "wh")
    feeds = feeds_from_tables(spark, SMALL)
    feeds.employment = feeds.employment.withColumn(
        "iso_code", F.when(F.col("_pos.o_orderkey") % 5 == 1, F.lit(None)).otherwise(F.col("iso_code")))
    with pytest.raises((PySparkException, Py4JJavaError)):
        R.run_refresh(spark, feeds, root, T0)
    assert Warehouse(spark, root).published_runs() == []


def test_run_from_files_matches_tables(spark):
    """CSV + JSON landed from the test tables give the same marts as the direct feeds."""
    d = fresh_scratch_path(spark, "inputs")
    e, u = testfeeds.employment_feed(spark, SMALL), testfeeds.unemployment_feed(spark, SMALL)
    files.write_rate_csv(e.orderBy("_pos"), f"{d}/employment")
    files.write_rate_csv(u.orderBy("_pos"), f"{d}/unemployment")
    files.write_population_json(testfeeds.population_objects(spark, SMALL), f"{d}/population")
    feeds = R.feeds_from_files(spark, f"{d}/employment", f"{d}/unemployment", f"{d}/population")
    root = fresh_scratch_path(spark, "wh")
    R.run_refresh(spark, feeds, root, T0)
    pub = R.published_marts(spark, root)
    lazy = layers_from_tables(spark, SMALL).marts()
    for name in ("fact", "total", "population", "with_population"):
        assert rows(getattr(pub, name)) == rows(getattr(lazy, name)), name


def _landed_inputs(spark, employment_extra: str = "", population_text: str | None = None):
    import os
    d = fresh_scratch_path(spark, "inputs")
    for name in ("employment", "unemployment", "population"):
        os.makedirs(f"{d}/{name}")
    header = "iso_code,country,sex,age,year,obs_value\n"
    with open(f"{d}/employment/e.csv", "w") as f:
        f.write(header + "AAA,A,Total,15+,2000,10.5\n" + employment_extra)
    with open(f"{d}/unemployment/u.csv", "w") as f:
        f.write(header + "AAA,A,Total,15+,2000,5.25\n")
    with open(f"{d}/population/p.json", "w") as f:
        f.write(population_text or '[{"alpha3Code": "AAA", "name": "A", "population": 1000}]')
    return R.feeds_from_files(spark, f"{d}/employment", f"{d}/unemployment", f"{d}/population")


@pytest.mark.parametrize("bad", ["csv_fields", "json_object"])
def test_bad_file_input_fails_and_keeps_previous_run(spark, bad):
    root = fresh_scratch_path(spark, "wh")
    good = R.run_refresh(spark, _landed_inputs(spark), root, T0)
    pub = R.published_marts(spark, root)
    assert [(r.iso_code, str(r.unemployment_persons_est)) for r in pub.with_population.collect()] == [
        ("AAA", "52.50")]
    if bad == "csv_fields":
        feeds = _landed_inputs(spark, employment_extra="BBB,B,Total,15+,2000\n")
    else:
        feeds = _landed_inputs(spark, population_text='{"alpha3Code": "AAA"}')
    with pytest.raises((PySparkException, Py4JJavaError)):
        R.run_refresh(spark, feeds, root, T0 + dt.timedelta(days=1))
    assert Warehouse(spark, root).current_run() == good.run_id
