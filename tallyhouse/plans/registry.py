"""Queries for the layers and operators, keyed by name, each over the benchmark tables.

Every entry takes ``(spark, sf_dir)`` and returns a DataFrame. Entries that land files
(CSV / JSON round trips, audit runs) write below the session's shared scratch folder.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse import schemas
from tallyhouse.functions import validate as V
from tallyhouse.functions.constraints import not_null_columns
from tallyhouse.operators import audit as A
from tallyhouse.operators.ntile import ntile
from tallyhouse.operators.upsert import insert_ignore, upsert, upsert_ordered
from tallyhouse.plans import marts as M
from tallyhouse.plans import staging as S
from tallyhouse.plans.layers import (FIXED_RUN_TS, build_layers, feeds_from_tables,
                                     layers_from_tables, written_marts)
from tallyhouse.session import fresh_scratch_path
from tallyhouse.sources import files, testfeeds
from tallyhouse.sources.file_fingerprints import FileFingerprints
from tallyhouse.sources.partitioned import PartitionedTable
from tallyhouse.sources.quoted_csv import csv_defects, read_quoted_csv
from tallyhouse.sources.split_json import read_split_json

Query = Callable[[SparkSession, str], DataFrame]
SIX = schemas.RATE_FILE_COLUMNS


def _layer(attr: str, cols: list[str] | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = getattr(layers_from_tables(spark, sf_dir), attr)
        return df.select(*cols) if cols else df
    return run


def _raw_employment(spark, sf_dir):
    return layers_from_tables(spark, sf_dir).raw_employment


def filter_year_regex(spark, sf_dir):
    """Raw employment rows whose year text is exactly four digits."""
    return _raw_employment(spark, sf_dir).filter(
        V.year_text_ok("year")).select(*SIX)


def filter_value_regex(spark, sf_dir):
    """Raw employment rows whose value text is a plain unsigned decimal."""
    return _raw_employment(spark, sf_dir).filter(
        V.rate_text_ok("obs_value")).select(*SIX)


def filter_range(spark, sf_dir):
    """Rows whose typed year is in 1991-2025 and typed, rounded rate in 0-100."""
    raw = _raw_employment(spark, sf_dir)
    y, r = V.typed_year("year"), V.typed_rate("obs_value")
    return raw.filter(V.year_in_range(y) & V.rate_in_range(r)).select(*SIX)


def filter_domain(spark, sf_dir):
    """Rows whose sex and age are in the allowed sets (case-sensitive)."""
    raw = _raw_employment(spark, sf_dir)
    return raw.filter(V.sex_ok("sex") & V.age_ok("age")).select(*SIX)


def assert_not_null_query(spark, sf_dir):
    """The rate fact with its NOT NULL columns checked row by row (passes on valid data)."""
    fact = layers_from_tables(spark, sf_dir).fact
    return not_null_columns(fact, ["iso_code", "country", "sex", "age", "year",
                                   "employment_rate", "unemployment_rate"],
                            "country_year_sex_age_rates")


AUDIT_SOURCES = {
    "occupazione_csv": SIX,
    "disoccupazione_csv": SIX,
    "population_api": ["iso_code", "country", "population"],
}


def audit_snapshots(spark, sf_dir):
    """Row count and fingerprint of the three raw sources (portable md5 hash)."""
    L = layers_from_tables(spark, sf_dir)
    snaps = [
        A.snapshot(L.raw_employment, "occupazione_csv", SIX, method="md5"),
        A.snapshot(L.raw_unemployment, "disoccupazione_csv", SIX, method="md5"),
        A.snapshot(L.raw_population, "population_api", AUDIT_SOURCES["population_api"],
                   method="md5"),
    ]
    out = snaps[0]
    for s in snaps[1:]:
        out = out.unionByName(s)
    return out


def audit_change_log(spark, sf_dir):
    """Four deliveries of the employment file audited in turn; all four change types.

    The deliveries differ by a condition on the same rows, so one pass over the feed takes
    all four snapshots, and each is classified against the one
    before it as the latest row of the history.
    """
    ok = F.col("_pos.o_orderkey")
    edited = [*SIX[:5], F.when(ok == 1, F.lit("99.999")).otherwise(F.col("obs_value"))]
    deliveries = {"A": (ok % 10 != 0, SIX), "B": (None, SIX), "C": (None, edited), "D": (None, edited)}
    path = fresh_scratch_path(spark, "audit-snapshots")
    one = A.snapshots(testfeeds.employment_feed(spark, sf_dir), deliveries, method="md5")
    one.write.parquet(path)
    snaps = spark.read.schema(one.schema).parquet(path)
    history = A.empty_history(spark)
    base = dt.datetime(2025, 1, 1)
    for i, name in enumerate(deliveries):
        snap = snaps.filter(F.col("source_name") == name).withColumn("source_name", F.lit("occupazione_csv"))
        history = history.unionByName(A.classify(snap, history, base + dt.timedelta(minutes=i)))
    return history.drop("observed_at")


def _raw_employment_run(spark, sf_dir, run):
    return S.land_rates(testfeeds.audit_run_feed(spark, sf_dir, run), FIXED_RUN_TS)


def upsert_do_nothing(spark, sf_dir):
    """Staging rerun without emptying: delivery B inserted-or-ignored into the staging
    table built from delivery A (existing keys keep A's row)."""
    raw_a = _raw_employment_run(spark, sf_dir, "A")
    raw_b = _raw_employment_run(spark, sf_dir, "B")
    target = S.stage_rates(raw_a, "employment_rate")
    source = S.validated_rates(raw_b, "employment_rate")
    return insert_ignore(target, source, schemas.RATE_KEYS, ["_pos"])


def upsert_do_update(spark, sf_dir):
    """Slice mart rerun without emptying: the slice from delivery B upserted into the
    slice from delivery A on (iso_code, year); all metrics update, the country does not."""
    feeds_b = feeds_from_tables(spark, sf_dir)
    feeds_a = feeds_from_tables(spark, sf_dir)
    feeds_a.employment = testfeeds.audit_run_feed(spark, sf_dir, "A")
    total_a = build_layers(feeds_a).total
    total_b = build_layers(feeds_b).total
    update = [c for c in M.SLICE_COLUMNS if c not in ("iso_code", "year", "country")]
    return upsert(total_a, total_b, schemas.SLICE_KEYS, update)


def ntile_distributed(spark, sf_dir):
    """NTILE(7) over the whole rate fact by employment rate (keys break ties), computed
    with range partitioning instead of a single-partition window."""
    fact = written_marts(spark, sf_dir).fact.select("iso_code", "sex", "age", "year", "employment_rate")
    return ntile(fact, 7, ["employment_rate", "iso_code", "sex", "age", "year"], out="bucket")


def csv_source(spark, sf_dir):
    """The employment feed written as CSV files and read back through the CSV source."""
    feed = testfeeds.employment_feed(spark, sf_dir)
    path = fresh_scratch_path(spark, "employment-csv")
    files.write_rate_csv(feed.orderBy("_pos"), path)
    return files.read_rate_csv(spark, path).select(*SIX)


def csv_quoted_breaks(spark, sf_dir):
    """The employment feed with line breaks and doubled quotes inside the country of every third
    order, written as CSV files and read back split."""
    ok = F.col("_pos.o_orderkey")
    broken = F.concat("country", F.lit('\n"'), ok.cast("string"), F.lit('"\r\n, '), "country")
    feed = testfeeds.employment_feed(spark, sf_dir).withColumn(
        "country", F.when(ok % 3 == 0, broken).otherwise(F.col("country")))
    path = fresh_scratch_path(spark, "employment-csv")
    files.write_rate_csv(feed.orderBy("_pos"), path)
    return read_quoted_csv(spark, path).select(*SIX)


def csv_strict_bytes(spark, sf_dir):
    """Lines, records, blank records and lines that are not UTF-8 of a damaged employment file: a
    blank line behind some orders, a stray byte or a line break inside a field in others."""
    ok = F.col("_pos.o_orderkey")
    stray = F.when(ok % 103 == 0, F.unhex(F.lit("FF")).cast("string")).otherwise(F.lit(""))
    inside = F.when(ok % 107 == 0, F.lit('"two\nlines"')).otherwise(F.lit("one"))
    blank = F.when(ok % 101 == 0, F.lit("\n")).otherwise(F.lit(""))
    line = F.concat("iso_code", F.lit(","), inside, stray, F.lit(","), "sex", F.lit(","), "age", F.lit(",2000,1"), blank)
    path = fresh_scratch_path(spark, "damaged-csv")
    testfeeds.employment_feed(spark, sf_dir).select(line).write.text(path)
    return csv_defects(spark, path).agg(
        *[F.sum(c).alias(c) for c in ("lines", "records", "blank_records", "invalid_lines")])


def json_source(spark, sf_dir):
    """Population objects landed as one JSON list document and read back split (VARIANT)."""
    objects = testfeeds.population_objects(spark, sf_dir)
    path = fresh_scratch_path(spark, "population-json")
    testfeeds.one_json_document(objects, path)
    return read_split_json(spark, path).select("code", "name", "population")


def json_source_files(spark, sf_dir):
    """Population objects written as many JSON list documents, each read by one task."""
    objects = testfeeds.population_objects(spark, sf_dir)
    path = fresh_scratch_path(spark, "population-json")
    files.write_population_json(objects, path)
    return files.read_population_json(spark, path).select("code", "name", "population")


def audit_file_partials(spark, sf_dir):
    """Two deliveries of employment files, the second with the files of the first and more: count and
    fingerprint of each, folded from one partial per file; files seen before are not read again."""
    ok = F.col("_pos.o_orderkey")
    feed = testfeeds.employment_feed(spark, sf_dir)
    base = fresh_scratch_path(spark, "deliveries")
    for name, rows in (("first", feed.filter(ok % 10 != 0)), ("more", feed.filter(ok % 10 == 0))):
        files.write_rate_csv(rows, f"{base}/{name}")
    audit = FileFingerprints(spark, f"{base}-partials", SIX, method="md5")
    one = audit.snapshot("occupazione_csv", files.read_rate_csv, [f"{base}/first"])
    two = audit.snapshot("occupazione_csv", files.read_rate_csv, [f"{base}/first", f"{base}/more"])
    return one.withColumn("delivery", F.lit(1)).unionByName(two.withColumn("delivery", F.lit(2)))


def run_metrics(spark, sf_dir):
    """One full refresh of the test feeds; the row count of every table as the run observed
    it while writing."""
    from tallyhouse.plans import refresh as R
    root = fresh_scratch_path(spark, "warehouse")
    return R.metrics_table(spark, R.run_refresh(spark, feeds_from_tables(spark, sf_dir), root, FIXED_RUN_TS))


def full_refresh(spark, sf_dir):
    """Two refresh runs of the same feeds into one warehouse: the audit log of the
    published runs reads first_load, then unchanged, for every source."""
    from tallyhouse.plans import refresh as R
    from tallyhouse.sources.warehouse import Warehouse
    root = fresh_scratch_path(spark, "warehouse")
    for i in range(2):
        R.run_refresh(spark, feeds_from_tables(spark, sf_dir), root,
                      FIXED_RUN_TS + dt.timedelta(days=i), hash_method="md5")
    Warehouse(spark, root).retain(1)       # the audit log outlives superseded tables
    return Warehouse(spark, root).audit_history().drop("observed_at", "run_id", "version")


def refresh_retry(spark, sf_dir):
    """A published run, then a retry with the same run time that fails after landing: the
    published fact is unchanged."""
    from tallyhouse.plans import refresh as R
    root = fresh_scratch_path(spark, "warehouse")
    feeds = feeds_from_tables(spark, sf_dir)
    R.run_refresh(spark, feeds, root, FIXED_RUN_TS)
    feeds.employment = feeds.employment.filter(F.col("_pos.o_orderkey") % 10 == 0)
    feeds.population_objects = feeds.population_objects.filter(F.lit(False))
    try:
        R.run_refresh(spark, feeds, root, FIXED_RUN_TS)
    except RuntimeError:
        return R.published_marts(spark, root).fact
    raise AssertionError("a refresh without population rows must fail")


def refresh_conflict(spark, sf_dir):
    """Two refreshes that overlap: the one that began first finishes last, loses and leaves nothing;
    the published fact is the other's, the only version."""
    from tallyhouse.plans import refresh as R
    from tallyhouse.sources.commits import CommitConflict
    from tallyhouse.sources.warehouse import Warehouse
    root = fresh_scratch_path(spark, "warehouse")
    early = feeds_from_tables(spark, sf_dir)
    early.employment = early.employment.filter(F.col("_pos.o_orderkey") % 10 == 0)
    slow = R.prepare_refresh(spark, early, root, FIXED_RUN_TS)
    R.run_refresh(spark, feeds_from_tables(spark, sf_dir), root, FIXED_RUN_TS)
    try:
        slow.publish()
    except CommitConflict:
        markers = Warehouse(spark, root).markers()
        return R.published_marts(spark, root, version=1).fact.select(
            "*", markers.agg(F.count(F.lit(1))).scalar().alias("versions"),
            markers.agg(F.max("version")).scalar().alias("newest"))
    raise AssertionError("a run based on a superseded version must not publish")


def load_times(spark, sf_dir):
    """Rows and distinct load times of the published tables of one run: one time per run."""
    from tallyhouse.plans import refresh as R
    from tallyhouse.sources.warehouse import Warehouse
    root = fresh_scratch_path(spark, "warehouse")
    R.run_refresh(spark, feeds_from_tables(spark, sf_dir), root, FIXED_RUN_TS)
    wh = Warehouse(spark, root)
    run, out = wh.current_run(), None
    for layer, table in R.LAYER_TABLES:
        df = wh.read(layer, table, run)
        at = next(c for c in df.columns if c.endswith("_at"))
        one = df.agg(F.count(F.lit(1)).alias("rows_in_table"), F.min(at).alias("first_load"),
                     F.max(at).alias("last_load")).select(F.lit(table).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def upsert_ordered_query(spark, sf_dir):
    """Population objects applied one after another, in arrival order, to the snapshot that
    holds every second customer's objects: the last valid object per code wins."""
    objects = testfeeds.population_objects(spark, sf_dir)
    valid = objects.filter(V.population_ok("population")).select(
        F.col("code").alias("iso_code"), F.col("name").alias("country"), "population", "_pos")
    target = S.validate_population(objects.filter(F.col("_pos.c_custkey") % 2 == 0))
    return upsert_ordered(target.select("iso_code", "country", "population"), valid, ["iso_code"], ["_pos"])


def not_null_violations(spark, sf_dir):
    """Valid rows that would abort a load, counted per NOT NULL column, on a feed that has
    lost keys and countries."""
    ok = F.col("_pos.o_orderkey")
    feed = testfeeds.employment_feed(spark, sf_dir).withColumns({
        "iso_code": F.when(ok % 11 == 0, F.lit(None)).otherwise(F.col("iso_code")),
        "country": F.when(ok % 13 == 0, F.lit(None)).otherwise(F.col("country"))})
    valid = feed.select("*", V.typed_year("year").alias("y"), V.typed_rate("obs_value").alias("r")).filter(
        V.rate_row_ok("y", "sex", "age", "r"))
    return valid.agg(F.count(F.lit(1)).alias("valid_rows"),
                     *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}") for c in ("iso_code", "country")])


# The same operators on marts that grow with the data: codes from the customer key.
def wide_mart_rates(spark, sf_dir):
    """The 4-key join and its metrics over 17,576 codes."""
    return written_marts(spark, sf_dir, wide=True).fact


def wide_top_gap(spark, sf_dir):
    """Latest year: top 10 rows of the wide fact by gap."""
    from tallyhouse.plans.queries import q06
    return q06(written_marts(spark, sf_dir, wide=True))


def wide_ntile(spark, sf_dir):
    """NTILE(7) over the whole wide fact."""
    fact = written_marts(spark, sf_dir, wide=True).fact.select("iso_code", "sex", "age", "year", "employment_rate")
    return ntile(fact, 7, ["employment_rate", "iso_code", "sex", "age", "year"], out="bucket")


def _wide_table(spark, df):
    """A partitioned table that holds ``df``."""
    table = PartitionedTable(spark, fresh_scratch_path(spark, "merged"), df.schema)
    table.merge(df, lambda target, source: source)
    return table


def wide_upsert_do_nothing(spark, sf_dir):
    """Insert-or-ignore of delivery B into the staging of delivery A, wide codes, merged by year."""
    a, b = (S.land_rates(testfeeds.audit_run_feed(spark, sf_dir, r, wide=True), FIXED_RUN_TS) for r in "AB")
    table = _wide_table(spark, S.stage_rates(a, "employment_rate"))
    table.insert_ignore(S.validated_rates(b, "employment_rate"), schemas.RATE_KEYS, ["_pos"])
    return table.read()


def wide_upsert_do_update(spark, sf_dir):
    """Insert-or-update of the wide fact from delivery B into that from delivery A, merged by year:
    rates and metrics update, the country does not."""
    feeds = feeds_from_tables(spark, sf_dir, wide=True)
    stg_u = S.stage_rates(S.land_rates(feeds.unemployment, FIXED_RUN_TS), "unemployment_rate")
    facts = [M.rates_fact(S.stage_rates(S.land_rates(testfeeds.audit_run_feed(spark, sf_dir, r, wide=True), FIXED_RUN_TS),
                                        "employment_rate"), stg_u) for r in "AB"]
    update = [c for c in facts[0].columns if c not in (*schemas.RATE_KEYS, "country")]
    table = _wide_table(spark, facts[0])
    table.upsert(facts[1], schemas.RATE_KEYS, update)
    return table.read()


def wide_keep_first_deliveries(spark, sf_dir):
    """The wide employment feed in three deliveries (every third order), merged one by one, the last
    one first: per key the first valid row by delivery, then position."""
    ok = F.col("_pos.o_orderkey")
    feed = S.land_rates(testfeeds.audit_run_feed(spark, sf_dir, "B", wide=True), FIXED_RUN_TS)
    table = None
    for delivery in (2, 0, 1):
        rows = S.validated_rates(feed.filter(ok % 3 == delivery), "employment_rate").select(
            "iso_code", "country", "sex", "age", "year", "employment_rate", F.lit(delivery).alias("delivery"),
            ok.alias("position"))
        table = table or PartitionedTable(spark, fresh_scratch_path(spark, "winners"), rows.schema)
        table.keep_first(rows, schemas.RATE_KEYS, ["delivery", "position"])
    return table.read()


def queries() -> dict[str, Query]:
    return {
        "raw_employment": _layer("raw_employment", SIX),
        "raw_unemployment": _layer("raw_unemployment", SIX),
        "raw_population": _layer("raw_population", ["iso_code", "country", "population"]),
        "stg_employment": _layer("stg_employment"),
        "stg_unemployment": _layer("stg_unemployment"),
        "stg_population": _layer("stg_population"),
        "mart_rates": _layer("fact"),
        "mart_total_15plus": _layer("total"),
        "mart_country_population": _layer("population"),
        "mart_total_with_population": _layer("with_population"),
        "filter_year_regex": filter_year_regex,
        "filter_value_regex": filter_value_regex,
        "filter_range": filter_range,
        "filter_domain": filter_domain,
        "assert_not_null": assert_not_null_query,
        "audit_snapshots": audit_snapshots,
        "audit_change_log": audit_change_log,
        "upsert_do_nothing": upsert_do_nothing,
        "upsert_do_update": upsert_do_update,
        "ntile_distributed": ntile_distributed,
        "csv_source": csv_source,
        "csv_quoted_breaks": csv_quoted_breaks,
        "csv_strict_bytes": csv_strict_bytes,
        "json_source": json_source,
        "json_source_files": json_source_files,
        "audit_file_partials": audit_file_partials,
        "run_metrics": run_metrics,
        "full_refresh": full_refresh,
        "refresh_retry": refresh_retry,
        "refresh_conflict": refresh_conflict,
        "load_times": load_times,
        "upsert_ordered": upsert_ordered_query,
        "not_null_violations": not_null_violations,
        "wide_mart_rates": wide_mart_rates,
        "wide_top_gap": wide_top_gap,
        "wide_ntile": wide_ntile,
        "wide_upsert_do_nothing": wide_upsert_do_nothing,
        "wide_upsert_do_update": wide_upsert_do_update,
        "wide_keep_first_deliveries": wide_keep_first_deliveries,
    }
