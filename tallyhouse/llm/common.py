"""Helpers shared by the training-data operators: staged tables, row numbers, components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"      # a word: a run without ASCII white space
SPACE = r"[\x20\x09-\x0D]"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Only a local session may
    leave it unset (tests); it then gets a private folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local($|\[)", spark.conf.get("spark.master", "local")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there, so a lost
    executor costs tasks of the current step only."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.__dict__["_scratch_path"] = path
    return out


def release(*tables: DataFrame | None) -> None:
    """Delete staged tables that nothing reads any more. Scratch space only: where the file
    system client cannot be reached they stay until the shared folder is cleared."""
    for df in tables:
        path = df.__dict__.pop("_scratch_path", None) if df is not None else None
        if path:
            spark = df.sparkSession
            try:
                place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
            except Exception:  # noqa: BLE001 - no file system client, as under Spark Connect
                return


def sheltered(df: DataFrame, needed: tuple[str, ...], run: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``run`` applied to the ``needed`` columns, all others packed out of its way in one column
    ``rest`` and unpacked afterwards. A column that ``run`` adds replaces an input column of its
    name."""
    others = [c for c in df.columns if c not in needed]
    own = [c for c in df.columns if c in needed]
    quoted = {c: F.col("`" + c.replace("`", "``") + "`") for c in df.columns}
    rest = [F.struct(*[quoted[c].alias(f"c{i}") for i, c in enumerate(others)]).alias("rest")] if others else []
    out = run(df.select(*own, *rest))
    added = [c for c in out.columns if c not in own and c != "rest"]
    back = {c: F.col("rest").getField(f"c{i}").alias(c) for i, c in enumerate(others)} | {c: F.col(c) for c in own}
    kept = [c for c in df.columns if c not in added and (c in others or c in out.columns)]
    return out.select(*[back[c] for c in kept], *added)


def share(wanted: int, total: int, *key: str) -> Column:
    """Whether a row is among about ``wanted`` of ``total``, by a hash of its key: the same rows
    on every run, and no task or driver gathers more than the sample itself."""
    if wanted >= total:
        return F.lit(True)
    return F.pmod(F.xxhash64(F.lit(99), *key), F.lit(1 << 40)) < int((1 << 40) * (wanted / total))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, *order: Column, name: str = "row_no") -> DataFrame:
    """``df`` with global row numbers from 0 in the given order.

    One range exchange; rows are counted per range and the counts (one row per range, so at
    most as many as shuffle partitions) are summed up and joined back. The ranges are
    written before they are counted, so counting and numbering see the same rows.
    """
    spark = df.sparkSession
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranges = staged(df.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
                    .withColumns({"_range": F.spark_partition_id(), "_local": local}), "numbered")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranges.groupBy("_range").agg(F.count("*").alias("_rows"))
               .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")))
    return (ranges.join(F.broadcast(offsets), "_range")
            .withColumn(name, F.col("_before") + F.col("_local"))
            .drop("_range", "_local", "_before"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b: long) as (id, component = smallest id).

    Distributed union-find by alternating stars: every round links the larger neighbours
    and then the smaller neighbours of each node to its smallest one, until the edges no
    longer change. Each round is written to the shared folder; per node only a minimum is
    kept, no neighbour list is gathered.
    """
    pairs = staged(_down(edges.select(F.col("a").cast("long"), F.col("b").cast("long"))), "links")
    state = _summary(pairs)
    while True:
        large = _star(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), False)
        small = staged(_star(large, True), "links")
        now = _summary(small)
        release(pairs)
        pairs = small
        if now == state:
            break
        state = now
    found = pairs.groupBy("a").agg(F.min("b").alias("component"))
    roots = pairs.select(F.col("b").alias("a")).distinct().withColumn("component", F.col("a"))
    return found.union(roots).select(F.col("a").alias("id"), "component")


def _down(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller id, once each."""
    return (edges.filter("a <> b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Large star: neighbours above a node move to its least neighbour (itself included).
    Small star: the neighbours below it and the node itself move to the least of them.
    A node's minimum is pre-aggregated and joined back (a hot node's rows can be split)."""
    least = edges.groupBy("a").agg(F.min("b").alias("_m"))
    joined = edges.join(least, "a").withColumn("_m", F.least("_m", "a"))
    if small:
        moved = joined.select(F.col("b").alias("a"), F.col("_m").alias("b")).union(
            least.select("a", F.least("_m", "a").alias("b")))
    else:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return _down(moved)


def _summary(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                    F.bit_xor(F.xxhash64("b", "a"))).first()
    return tuple(row)
