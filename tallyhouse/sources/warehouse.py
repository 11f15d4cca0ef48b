"""Warehouse layout on shared storage, with all-or-nothing publication of runs.

    <root>/runs/run_id=<id>/<layer>/<table>/    every table of one run (Parquet)
    <root>/audit/run_id=<id>/                   its rows of the audit log
    <root>/_versions/<number>.json              one small file per published run
    <root>/_audit_checkpoints/                  the audit log of many runs in a few files

A run writes all of its tables first and commits its version last; readers resolve the newest
version (or pin one), so a run that fails half way is never visible and the previous run stays
readable. A run states the version it started from: of two runs that overlap, the one that commits
second fails and is rolled back (``commits.CommitConflict``). The order of versions is their number;
no clock decides. Nothing that exists is ever written again: run ids are unique and writes refuse an
existing path.

The audit log is one table outside the run folders; it outlives the tables of superseded runs, which
``retain`` deletes. Every COMPACT_EVERY versions its rows are written together as a checkpoint, with
the latest row per source, so that looking up what a source held last reads the newest checkpoint and
at most as many run folders as were published since, however many there have been.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tallyhouse import schemas
from tallyhouse.operators.audit import latest_rows
from tallyhouse.sources.commits import CommitConflict, CommitLog

INGESTION, STAGING, MART = "ingestion", "staging", "mart"

# Tables partitioned by year: 12 of the 19 catalogue queries read one year.
YEAR_PARTITIONED = {"country_year_sex_age_rates", "country_year_total_15plus",
                    "country_year_total_15plus_with_population"}

# Column order of the year-partitioned tables (a partition column is read back last).
COLUMN_ORDER = {
    "country_year_sex_age_rates": ["iso_code", "country", "sex", "age", "year",
                                   "employment_rate", "unemployment_rate",
                                   "unemployment_to_employment_ratio",
                                   "unemployment_minus_employment"],
    "country_year_total_15plus": ["iso_code", "country", "year", "employment_rate_15plus_total",
                                  "unemployment_rate_15plus_total",
                                  "unemployment_to_employment_ratio",
                                  "unemployment_minus_employment"],
    "country_year_total_15plus_with_population": [
        "iso_code", "country", "year", "population", "employment_rate_15plus_total",
        "unemployment_rate_15plus_total", "unemployment_to_employment_ratio",
        "unemployment_minus_employment", "employment_persons_est", "unemployment_persons_est"],
}


MARKER = "version bigint, run_id string, run_ts string"
COMPACT_EVERY = 32
AUDIT_ROW = T.StructType([*schemas.AUDIT.fields, T.StructField("run_id", T.StringType())])
AUDIT_VERSIONED = T.StructType([*AUDIT_ROW.fields, T.StructField("version", T.LongType())])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the cluster's Hadoop file system client (or, without a
    JVM gateway as under Spark Connect, by trying to read the path)."""
    try:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.exists(hpath))
    except Exception:  # noqa: BLE001
        from pyspark.errors import AnalysisException
        try:
            spark.read.parquet(path).schema
            return True
        except AnalysisException:
            return False


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/_versions")
        self.checkpoints = CommitLog(spark, f"{self.root}/_audit_checkpoints/log")

    # ----- layout -----
    def run_path(self, run_id: str) -> str:
        return f"{self.root}/runs/run_id={run_id}"

    def table_path(self, run_id: str, layer: str, table: str) -> str:
        return f"{self.run_path(run_id)}/{layer}/{table}"

    @property
    def audit_path(self) -> str:
        return f"{self.root}/audit"

    # ----- writing -----
    def write(self, df: DataFrame, run_id: str, layer: str, table: str,
              observation: Observation | None = None, *metrics) -> str:
        """Write one table of a run; ``metrics`` are observed during the same pass."""
        path = self.table_path(run_id, layer, table)
        by_year = table in YEAR_PARTITIONED
        if by_year:
            # One exchange that AQE sizes by bytes: few files per year, hot years split.
            df = df.hint("rebalance", "year")
        if observation is not None:
            # No exchange between the observation and the write: the metrics are taken in
            # the result stage, where a retried task's update is applied only once.
            df = df.observe(observation, *metrics)
        if by_year:
            # Row groups clustered by iso_code for the single-country queries.
            (df.sortWithinPartitions("year", "iso_code").write.mode("errorifexists")
               .partitionBy("year").parquet(path))
        else:
            df.write.mode("errorifexists").parquet(path)
        return path

    def write_audit(self, rows: DataFrame, run_id: str) -> None:
        """Append a run's audit rows; they show once the run is published."""
        rows.write.mode("errorifexists").parquet(f"{self.audit_path}/run_id={run_id}")

    def _delete(self, path: str) -> bool:
        try:
            jvm = self.spark.sparkContext._jvm
            hpath = jvm.org.apache.hadoop.fs.Path(path)
            fs = hpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            return bool(fs.delete(hpath, True)) if fs.exists(hpath) else True
        except Exception:  # noqa: BLE001 - no JVM gateway: leave the files
            return False

    def discard(self, run_id: str) -> bool:
        """Delete the files of an unpublished run (the rollback of a failed run).
        Refuses to touch a published run. Returns False when deletion is unavailable."""
        if self.is_published(run_id):
            raise ValueError(f"run {run_id} is published")
        return self._delete(self.run_path(run_id)) & self._delete(f"{self.audit_path}/run_id={run_id}")

    def retain(self, keep: int = 1) -> list[str]:
        """Delete the tables of all published runs but the last ``keep``; their audit rows
        stay. Looks at the run folders that still exist, not at every run ever made."""
        jvm = self.spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(f"{self.root}/runs")
        fs = hpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        present = [x.getPath().getName().removeprefix("run_id=") for x in fs.listStatus(hpath)]
        order = (self.markers().filter(F.col("run_id").isin(present))
                 .orderBy(F.desc("version")).select("run_id").collect())
        old = [r.run_id for r in order[max(keep, 1):]]
        for run_id in old:
            self._delete(self.run_path(run_id))
        return old

    def publish(self, run_id: str, run_ts: dt.datetime, base: int) -> int:
        """Make a run the version after ``base``, the one it started from; raises
        ``CommitConflict`` if another run has been published since."""
        return self.log.commit(base, {"run_id": run_id, "run_ts": run_ts.isoformat()})

    # ----- reading -----
    def version(self) -> int:
        """The newest version, 0 before the first."""
        return self.log.latest()

    def run_at(self, version: int) -> str:
        """The run of a version, for readers that pin one."""
        return self.log.entry(version)["run_id"]

    def markers(self) -> DataFrame:
        """One row per published run: version, run_id, run_ts."""
        return self.log.entries(MARKER)

    def is_published(self, run_id: str) -> bool:
        return not self.markers().filter(F.col("run_id") == run_id).isEmpty()

    def published_runs(self) -> list[str]:
        """Published run ids, oldest version first (for inspection)."""
        return [r.run_id for r in self.markers().orderBy("version").collect()]

    def current_run(self) -> str:
        """The run of the newest version."""
        version = self.version()
        if not version:
            raise RuntimeError(f"no published run under {self.root}")
        return self.run_at(version)

    def read(self, layer: str, table: str, run_id: str | None = None,
             schema=None) -> DataFrame:
        """A table of a run; with ``schema`` (known from the write) no file footer has to
        be read to plan the scan."""
        run_id = run_id or self.current_run()
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
        df = reader.parquet(self.table_path(run_id, layer, table))
        if table in YEAR_PARTITIONED:
            loaded = [c for c in df.columns if c == schemas.LOADED_AT]
            df = df.withColumn("year", F.col("year").cast("int")).select(*COLUMN_ORDER[table], *loaded)
        return df

    # ----- audit log -----
    def _audit_tail(self, after: int, until: int) -> DataFrame:
        """Audit rows of the versions ``after`` + 1 to ``until``, read from their folders."""
        runs = self.log.entries(MARKER, after, until).select("version", "run_id").collect()
        if not runs:
            return self.spark.createDataFrame([], AUDIT_VERSIONED)
        rows = (self.spark.read.schema(AUDIT_ROW).option("basePath", self.audit_path)
                .parquet(*[f"{self.audit_path}/run_id={r.run_id}" for r in runs]))
        return rows.join(self.spark.createDataFrame(runs, "version bigint, run_id string"), "run_id").select(
            *AUDIT_VERSIONED.fieldNames())

    def _checkpoint(self, until: int) -> dict:
        """The newest audit checkpoint that holds no version beyond ``until``."""
        number = self.checkpoints.latest()
        while number and self.checkpoints.entry(number)["until"] > until:
            number -= 1
        return self.checkpoints.entry(number) if number else {"until": 0, "segments": []}

    def _part(self, name: str, part: str) -> DataFrame:
        return self.spark.read.schema(AUDIT_VERSIONED).parquet(f"{self.root}/_audit_checkpoints/{name}/{part}")

    def audit_latest(self, version: int | None = None) -> DataFrame:
        """The latest audit row of every source at a version (default: the newest): the newest
        checkpoint's and those of the runs since."""
        version = self.version() if version is None else version
        seen = self._checkpoint(version)
        tail = self._audit_tail(seen["until"], version)
        if seen["segments"]:
            tail = tail.unionByName(self._part(seen["segments"][-1], "latest"))
        return latest_rows(tail)

    def audit_history(self, version: int | None = None) -> DataFrame:
        """Audit rows of all published runs up to a version, with run_id and version: one folder per
        checkpoint and one per run since."""
        version = self.version() if version is None else version
        seen = self._checkpoint(version)
        rows = self._audit_tail(seen["until"], version)
        for name in seen["segments"]:
            rows = rows.unionByName(self._part(name, "rows"))
        return rows

    def compact_audit(self, version: int) -> bool:
        """Write a checkpoint once COMPACT_EVERY versions have been published since the last one."""
        number = self.checkpoints.latest()
        seen = self.checkpoints.entry(number) if number else {"until": 0, "segments": []}
        if version - seen["until"] < COMPACT_EVERY:
            return False
        name = f"until-{version:020d}-{uuid.uuid4().hex[:12]}"
        place = f"{self.root}/_audit_checkpoints/{name}"
        self._audit_tail(seen["until"], version).coalesce(1).write.parquet(f"{place}/rows")
        self.audit_latest(version).coalesce(1).write.parquet(f"{place}/latest")
        try:
            self.checkpoints.commit(number, {"until": version, "segments": [*seen["segments"], name]})
        except CommitConflict:      # another run wrote one for the same versions
            self._delete(place)
            return False
        return True
