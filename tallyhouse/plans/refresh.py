"""One full refresh run: land -> stage -> marts -> audit, published all at once.

Every layer is written to shared storage and read back by the next step, so lineage is
cut at each table: a lost executor costs a retry of tasks of the current step, never a
recomputation from the sources. Row counts (and the raw fingerprints of the audit) are
observed while the tables are written, so no table is scanned a second time for them.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tallyhouse import schemas
from tallyhouse.functions.constraints import not_null_columns
from tallyhouse.functions.fingerprint import fingerprint_agg
from tallyhouse.operators import audit as A
from tallyhouse.plans import marts as M
from tallyhouse.plans import staging as S
from tallyhouse.plans.layers import Feeds
from tallyhouse.sources import files
from tallyhouse.sources.file_fingerprints import FileFingerprints
from tallyhouse.sources.quoted_csv import read_quoted_csv
from tallyhouse.sources.split_json import read_split_json
from tallyhouse.sources.warehouse import INGESTION, MART, STAGING, Warehouse

# Source names recorded in the audit log.
EMPLOYMENT_SOURCE = "occupazione_csv"
UNEMPLOYMENT_SOURCE = "disoccupazione_csv"
POPULATION_SOURCE = "population_api"

# Table names of the three layers.
RAW_EMPLOYMENT, RAW_UNEMPLOYMENT, RAW_POPULATION = "employment_raw", "unemployment_raw", "population_raw"
STG_EMPLOYMENT, STG_UNEMPLOYMENT, STG_POPULATION = "employment_stg", "unemployment_stg", "population_stg"
FACT, TOTAL, POPULATION, WITH_POPULATION = (
    "country_year_sex_age_rates", "country_year_total_15plus", "country_population",
    "country_year_total_15plus_with_population")
AUDIT = "etl_source_audit"

POPULATION_FINGERPRINT_COLUMNS = ["iso_code", "country", "population"]


@dataclass
class RunResult:
    run_id: str
    metrics: dict[str, int] = field(default_factory=dict)
    snapshots: dict[str, tuple[int, int]] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)


def feeds_from_files(spark: SparkSession, employment_csv, unemployment_csv, population_json,
                     strict_bytes: bool = True) -> Feeds:
    """The three feeds as landed. Rate files are split, may hold line breaks inside quoted fields, and
    fail the run on blank lines and bytes that are not UTF-8; ``strict_bytes=False`` reads them with
    Spark's CSV source alone (one pass, no such checks, no line breaks inside fields)."""
    read = read_quoted_csv if strict_bytes else files.read_rate_csv
    return Feeds(read(spark, employment_csv), read(spark, unemployment_csv), read_split_json(spark, population_json))


def changed_rate_files(spark: SparkSession, warehouse_root: str, employment_csv, unemployment_csv) -> DataFrame:
    """How the rate files that lie ready differ from what the newest run loaded: its audit rows, without
    landing anything. One (count, fingerprint) partial per file is kept with the warehouse, so only
    files that are new or changed since the last look are read."""
    wh = Warehouse(spark, warehouse_root)
    partials = FileFingerprints(spark, f"{wh.root}/_file_fingerprints", schemas.RATE_FILE_COLUMNS)
    now = [partials.snapshot(name, read_quoted_csv, path) for name, path in (
        (EMPLOYMENT_SOURCE, employment_csv), (UNEMPLOYMENT_SOURCE, unemployment_csv))]
    return A.classify(now[0].unionByName(now[1]), wh.audit_latest(), F.localtimestamp())


def _load_column(table: str) -> str:
    return schemas.SNAPSHOT_AT if table == POPULATION else schemas.LOADED_AT


def _count() -> F.Column:
    return F.count(F.lit(1)).alias("rows")


def run_refresh(spark: SparkSession, feeds: Feeds, warehouse_root: str,
                run_ts: dt.datetime | None = None, strict: bool = False,
                hash_method: str = "xxhash64") -> RunResult:
    """Rebuild every table from the feeds into a new run directory and publish it.

    Raises (and publishes nothing) on: a malformed CSV row, a NULL key in a valid row,
    a non-list population payload, zero valid population rows, an out-of-range rate
    under ``strict``, another run published while this one ran (``CommitConflict``). A failed
    run is rolled back: its directory is deleted. Every attempt has a run id of its own (time
    and a random part), so a retry with the same ``run_ts`` never meets the files of an earlier
    run, published or not.
    """
    return prepare_refresh(spark, feeds, warehouse_root, run_ts, strict, hash_method).publish()


class PreparedRun:
    """A run whose tables are all written, based on the version that was current when it began."""

    def __init__(self, wh: Warehouse, result: RunResult, run_ts: dt.datetime, base: int):
        self.wh, self.result, self.run_ts, self.base = wh, result, run_ts, base

    def publish(self) -> RunResult:
        """Make the run the version after the one it started from, or roll it back."""
        with _rolled_back(self.wh, self.result.run_id):
            self.wh.publish(self.result.run_id, self.run_ts, self.base)
        return self.result


@contextmanager
def _rolled_back(wh: Warehouse, run_id: str):
    """Delete a run's files if the block fails."""
    try:
        yield
    except BaseException:
        try:  # best effort: the original error is what the caller must see
            wh.discard(run_id)
        except Exception:  # noqa: BLE001
            pass
        raise


def prepare_refresh(spark: SparkSession, feeds: Feeds, warehouse_root: str,
                    run_ts: dt.datetime | None = None, strict: bool = False,
                    hash_method: str = "xxhash64") -> PreparedRun:
    """The first part of ``run_refresh``: everything but the publication."""
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    run_id = f"{run_ts.strftime('%Y%m%dT%H%M%S%f')}-{uuid.uuid4().hex[:12]}"
    wh = Warehouse(spark, warehouse_root)
    base = wh.version()
    wh.compact_audit(base)
    with _rolled_back(wh, run_id):
        return PreparedRun(wh, _run(spark, feeds, wh, run_id, run_ts, base, strict, hash_method), run_ts, base)


def _run(spark: SparkSession, feeds: Feeds, wh: Warehouse, run_id: str, run_ts: dt.datetime,
         base: int, strict: bool, hash_method: str) -> RunResult:
    result = RunResult(run_id)
    at = F.lit(run_ts).cast("timestamp_ntz")

    def write(df: DataFrame, layer: str, table: str, fingerprint_cols=None) -> DataFrame:
        started = time.perf_counter()
        obs = Observation(table)
        metrics = [_count()]
        if fingerprint_cols is not None:
            metrics.append(fingerprint_agg(*fingerprint_cols, method=hash_method).alias("fp"))
        checked = not_null_columns(df, schemas.REQUIRED.get(table, ()), table)
        if layer != INGESTION:
            checked = checked.withColumn(_load_column(table), at)
        wh.write(checked, run_id, layer, table, obs, *metrics)
        got = obs.get
        result.metrics[table] = int(got["rows"])
        if fingerprint_cols is not None:
            result.snapshots[table] = (int(got["rows"]), int(got["fp"]))
        result.seconds[table] = round(time.perf_counter() - started, 3)
        back = wh.read(layer, table, run_id, schema=checked.schema)
        return back if layer == INGESTION else back.drop(_load_column(table))

    six = schemas.RATE_FILE_COLUMNS
    # Ingestion: land both rate feeds as text, plus the validated population objects.
    raw_e = write(S.land_rates(feeds.employment, at), INGESTION, RAW_EMPLOYMENT, six)
    raw_u = write(S.land_rates(feeds.unemployment, at), INGESTION, RAW_UNEMPLOYMENT, six)

    # Staging and rate marts.
    stg_e = write(S.stage_rates(raw_e, "employment_rate", strict=strict), STAGING, STG_EMPLOYMENT)
    stg_u = write(S.stage_rates(raw_u, "unemployment_rate", strict=strict), STAGING, STG_UNEMPLOYMENT)
    fact = write(M.rates_fact(stg_e, stg_u), MART, FACT)
    total = write(M.total_15plus(fact), MART, TOTAL)

    raw_p = write(S.land_population(feeds.population_objects, at), INGESTION, RAW_POPULATION,
                  POPULATION_FINGERPRINT_COLUMNS)
    if result.metrics[RAW_POPULATION] == 0:
        raise RuntimeError("population feed holds no valid rows")

    # Audit of the three sources against the published history.
    current = A.observed_snapshot(spark, {
        EMPLOYMENT_SOURCE: result.snapshots[RAW_EMPLOYMENT],
        UNEMPLOYMENT_SOURCE: result.snapshots[RAW_UNEMPLOYMENT],
        POPULATION_SOURCE: result.snapshots[RAW_POPULATION],
    })
    audit = not_null_columns(A.classify(current, wh.audit_latest(base), at), schemas.REQUIRED[AUDIT], AUDIT)
    counted = Observation(AUDIT)
    wh.write_audit(audit.observe(counted, _count()), run_id)
    result.metrics[AUDIT] = int(counted.get["rows"])

    # Population staging and marts.
    stg_p = write(S.stage_population(raw_p), STAGING, STG_POPULATION)
    pop = write(M.country_population(stg_p), MART, POPULATION)
    write(M.total_with_population(total, pop), MART, WITH_POPULATION)
    return result


def published_marts(spark: SparkSession, warehouse_root: str, run_id: str | None = None,
                    version: int | None = None):
    """The four marts of the current published run, or of a given run or version."""
    from tallyhouse.plans.queries import Marts
    wh = Warehouse(spark, warehouse_root)
    run_id = run_id or (wh.run_at(version) if version else wh.current_run())
    def mart(table: str) -> DataFrame:
        return wh.read(MART, table, run_id).drop(_load_column(table))

    return Marts(mart(FACT), mart(TOTAL), mart(POPULATION), mart(WITH_POPULATION))


LAYER_TABLES = [
    (INGESTION, RAW_EMPLOYMENT), (INGESTION, RAW_UNEMPLOYMENT), (INGESTION, RAW_POPULATION),
    (STAGING, STG_EMPLOYMENT), (STAGING, STG_UNEMPLOYMENT), (STAGING, STG_POPULATION),
    (MART, FACT), (MART, TOTAL), (MART, POPULATION), (MART, WITH_POPULATION),
]


def metrics_table(spark: SparkSession, result: RunResult) -> DataFrame:
    """The row counts a run observed while it wrote its tables (one row per table)."""
    return spark.createDataFrame(sorted(result.metrics.items()), "table_name string, row_count bigint")
