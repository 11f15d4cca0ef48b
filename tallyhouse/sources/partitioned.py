"""A table in partitions whose merges rewrite only the partitions that the new rows touch.

    <folder>/_versions/<number>.json     version: the folder of every partition value
    <folder>/data-<id>/p=<value>/        Parquet files of one partition, never written again

A merge finds the partition values of its source (one row each), reads those partitions of the
version it starts from, writes their new contents beside them and commits a version that names the
new folders and, for all other values, the old ones. Untouched partitions are neither read nor
copied. Two merges that overlap: the second to commit fails (``commits.CommitConflict``) and its
files are deleted. A version's list has one path per partition value, whatever the rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyhouse.operators.dedup import keep_first
from tallyhouse.operators.upsert import insert_ignore, upsert
from tallyhouse.session import fresh_scratch_path
from tallyhouse.sources.commits import CommitLog, FileSystem

Merge = Callable[[DataFrame, DataFrame], DataFrame]


class PartitionedTable:
    """A table of ``schema``, partitioned by the values of one of its columns (never NULL)."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, partition: str = "year"):
        self.spark, self.folder, self.schema, self.partition = spark, folder.rstrip("/"), schema, partition
        self.log = CommitLog(spark, f"{self.folder}/_versions")

    def version(self) -> int:
        return self.log.latest()

    def parts(self, version: int | None = None) -> dict[str, str]:
        """Partition value (as text) -> its folder, relative to the table's."""
        return self.log.entry(self.version() if version is None else version).get("parts", {})

    def read(self, version: int | None = None, values: Sequence | None = None) -> DataFrame:
        """The rows of a version, or only of some partition values; other folders are not opened."""
        parts = self.parts(version)
        wanted = parts.values() if values is None else [parts[str(v)] for v in values if str(v) in parts]
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        # the folders are named one by one, so their names are not searched for columns
        return (self.spark.read.schema(self.schema).option("recursiveFileLookup", True)
                .parquet(*[f"{self.folder}/{w}" for w in sorted(wanted)]))

    def merge(self, source: DataFrame, how: Merge) -> int:
        """Commit ``how(target, source)`` for the partitions that ``source`` touches, where ``target``
        holds those partitions only. ``how`` must not move a row to another partition."""
        base = self.version()
        path = fresh_scratch_path(self.spark, "merge-source")
        source.write.parquet(path)
        source = self.spark.read.schema(source.schema).parquet(path)
        touched = [r[0] for r in source.select(self.partition).distinct().collect()]   # one row per partition
        if not touched:
            return base
        data = f"data-{uuid.uuid4().hex}"
        merged = how(self.read(base, touched), source).select(*self.schema.fieldNames())
        try:
            (merged.withColumn("p", F.col(self.partition)).hint("rebalance", "p")
             .write.partitionBy("p").parquet(f"{self.folder}/{data}"))
            files = FileSystem(self.spark)
            new = {unquote(n.removeprefix("p=")): f"{data}/{n}"
                   for n in files.names(f"{self.folder}/{data}") if n.startswith("p=")}
            return self.log.commit(base, {"parts": {**self.parts(base), **new}})
        except BaseException:
            FileSystem(self.spark).delete(f"{self.folder}/{data}")
            raise

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete the partition folders that none of the last ``keep`` versions names (they must not
        be read any more, and no merge may be running)."""
        newest = self.version()
        used = {path for v in range(max(1, newest - max(keep, 1) + 1), newest + 1) for path in self.parts(v).values()}
        files = FileSystem(self.spark)
        old = [f"{d}/{n}" for d in files.names(self.folder) if d.startswith("data-")
               for n in files.names(f"{self.folder}/{d}") if n.startswith("p=") and f"{d}/{n}" not in used]
        for path in old:
            files.delete(f"{self.folder}/{path}")
        return old

    def _check(self, keys: Sequence[str]) -> None:
        if self.partition not in keys:
            raise ValueError(f"the partition column {self.partition} must be part of the key")

    def upsert(self, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str]) -> int:
        """Insert new keys; overwrite ``update_cols`` of existing ones."""
        self._check(keys)
        return self.merge(source, lambda t, s: upsert(t, s, keys, update_cols))

    def insert_ignore(self, source: DataFrame, keys: Sequence[str], order: Sequence[str]) -> int:
        """Add the rows of new keys (first by ``order``); existing keys keep their row."""
        self._check(keys)
        return self.merge(source, lambda t, s: insert_ignore(t, s, keys, order))

    def keep_first(self, source: DataFrame, keys: Sequence[str], order: Sequence[str]) -> int:
        """Keep, per key, the row with the smallest ``order`` among those kept so far and the new ones.
        The order columns are part of the table, so deliveries may be merged in any order, or twice,
        and the result is that of one pass over all of them; earlier deliveries are not read again."""
        self._check(keys)
        payload = [c for c in self.schema.fieldNames() if c not in keys]
        first = lambda rows: keep_first(rows, keys, order, payload)
        return self.merge(first(source), lambda t, s: first(t.unionByName(s)))
