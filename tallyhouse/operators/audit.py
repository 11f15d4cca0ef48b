"""Per-source change audit: snapshot (row count + fingerprint) and classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyhouse import schemas
from tallyhouse.functions.fingerprint import fingerprint_agg

# Change types written to the audit log.
FIRST_LOAD = "first_load"
ROW_COUNT_CHANGED = "row_count_changed"
CONTENT_CHANGED = "content_changed_same_count"
UNCHANGED = "unchanged"


def snapshots(df: DataFrame, parts: dict[str, tuple[Column | None, Sequence]], method: str = "xxhash64") -> DataFrame:
    """One row per name in ``parts``: ``source_name, observed_rows, observed_fingerprint`` of the rows
    that meet its condition (None: all), hashed over its columns; all of them in one pass.

    A global aggregate with partial aggregation: each task folds its rows into a
    (count, xor) pair per name; only those pairs are exchanged.
    """
    def one(name: str, keep: Column | None, cols: Sequence) -> Column:
        kept = F.lit(True) if keep is None else keep
        return F.struct(F.lit(name).alias("source_name"), F.count(F.when(kept, 1)).alias("observed_rows"),
                        fingerprint_agg(*cols, method=method, where=keep).alias("observed_fingerprint"))

    return df.agg(F.array(*[one(n, *p) for n, p in parts.items()]).alias("s")).select(F.inline("s"))


def snapshot(df: DataFrame, source_name: str, cols: Sequence, method: str = "xxhash64") -> DataFrame:
    """One row: ``source_name, observed_rows, observed_fingerprint``."""
    return snapshots(df, {source_name: (None, cols)}, method)


def observed_snapshot(spark: SparkSession, values: dict[str, tuple[int, int]]) -> DataFrame:
    """Snapshot rows from metrics already observed during a write (no second pass)."""
    rows = [(name, int(n), int(fp)) for name, (n, fp) in values.items()]
    return spark.createDataFrame(
        rows, "source_name string, observed_rows bigint, observed_fingerprint bigint")


def empty_history(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.AUDIT)


def _when(history: DataFrame) -> list[str]:
    """The order of audit rows: by version where the history knows it, then by time, equal times
    by run id."""
    return [c for c in ("version", "observed_at", "run_id") if c in history.columns]


def latest_rows(history: DataFrame) -> DataFrame:
    """The most recent audit row of every source, with all its columns."""
    others = [c for c in history.columns if c != "source_name"]
    last = F.max_by(F.struct(*others), F.struct(*_when(history))).alias("_last")
    return history.groupBy("source_name").agg(last).select("source_name", "_last.*").select(*history.columns)


def latest_per_source(history: DataFrame) -> DataFrame:
    """What every source held last (all sources in one aggregation)."""
    when = _when(history)
    latest = F.max_by(F.struct("observed_rows", "observed_fingerprint"), F.struct(*when))
    return (history.groupBy("source_name").agg(latest.alias("_p"))
                   .select("source_name",
                           F.col("_p.observed_rows").alias("previous_rows"),
                           F.col("_p.observed_fingerprint").alias("previous_fingerprint")))


def classify(current: DataFrame, history: DataFrame, observed_at) -> DataFrame:
    """New audit rows for ``current`` snapshots, compared with the latest of ``history``.

    ``new_rows`` / ``removed_rows`` are net counts (growth or shrinkage of the row count).
    """
    prev = latest_per_source(history)
    joined = current.join(prev, on="source_name", how="left")
    has_prev = F.col("previous_rows").isNotNull()
    delta = F.col("observed_rows") - F.col("previous_rows")
    at = observed_at if isinstance(observed_at, Column) else F.lit(observed_at)
    return joined.select(
        "source_name",
        "observed_rows",
        "observed_fingerprint",
        "previous_rows",
        "previous_fingerprint",
        F.when(has_prev, delta).alias("delta_rows"),
        F.when(has_prev, F.greatest(delta, F.lit(0))).otherwise(F.col("observed_rows")).alias("new_rows"),
        F.when(has_prev, F.greatest(-delta, F.lit(0))).otherwise(F.lit(0).cast("bigint")).alias("removed_rows"),
        F.when(~has_prev, F.lit(FIRST_LOAD))
         .when(delta != 0, F.lit(ROW_COUNT_CHANGED))
         .when(F.col("observed_fingerprint") != F.col("previous_fingerprint"), F.lit(CONTENT_CHANGED))
         .otherwise(F.lit(UNCHANGED)).alias("change_type"),
        at.cast("timestamp_ntz").alias("observed_at"),
    )
