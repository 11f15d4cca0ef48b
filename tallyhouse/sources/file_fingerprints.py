"""Fingerprints of a delivery folded from one partial per landed file.

Row count and XOR of row hashes can be taken per file and combined: counts add up, fingerprints XOR.
A partial is kept for every file ever looked at, under its path, size and modification time. The
snapshot of a delivery lists its files (no content is read), reads those without a partial, and folds
one row per file. Files that two deliveries share are read once.

A file replaced by one of the same size within the resolution of modification times is not noticed.
Partials are only ever added, each look in a folder of its own; the same partial twice is harmless.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.functions.fingerprint import fingerprint_agg
from tallyhouse.sources.commits import FileSystem

IDENTITY = ["file", "size", "modified"]
PARTIAL = "file string, size bigint, modified timestamp, observed_rows bigint, observed_fingerprint bigint"


def listed(spark: SparkSession, path) -> DataFrame:
    """The files of ``path`` with size and modification time; nothing is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return found.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
                        F.col("_metadata.file_modification_time").alias("modified"))


class FileFingerprints:
    """Partials over ``cols``, hashed by ``method``, kept below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, cols: Sequence[str], method: str = "xxhash64"):
        self.spark, self.folder, self.cols, self.method = spark, folder.rstrip("/"), list(cols), method

    def known(self) -> DataFrame:
        """One row per file, size and time looked at so far."""
        # by name: two reads of one folder count as the same table in a plan, whatever was added between
        looks = sorted(FileSystem(self.spark).names(self.folder))
        if not looks:
            return self.spark.createDataFrame([], PARTIAL)
        rows = self.spark.read.schema(PARTIAL).parquet(*[f"{self.folder}/{x}" for x in looks])
        return rows.groupBy(*IDENTITY).agg(F.any_value("observed_rows").alias("observed_rows"),
                                           F.any_value("observed_fingerprint").alias("observed_fingerprint"))

    def look(self, read: Callable[[SparkSession, list[str]], DataFrame], path) -> DataFrame:
        """Partials of the files of ``path``; those not known yet are read (``read`` gives rows with
        ``_pos.file``) and kept. Only names of new files come to the driver, as for any read."""
        files = listed(self.spark, path)
        new = files.join(self.known(), IDENTITY, "left_anti")
        names = [unquote(r.file) for r in new.select("file").collect()]
        if names:
            rows = read(self.spark, names).groupBy(F.col("_pos.file").alias("file")).agg(
                F.count(F.lit(1)).alias("observed_rows"),
                fingerprint_agg(*self.cols, method=self.method).alias("observed_fingerprint"))
            none = F.lit(0).cast("bigint")      # a file without rows has a partial too
            new.join(rows, "file", "left").select(
                *IDENTITY, F.coalesce("observed_rows", none).alias("observed_rows"),
                F.coalesce("observed_fingerprint", none).alias("observed_fingerprint")
            ).coalesce(1).write.parquet(f"{self.folder}/{uuid.uuid4().hex}")
        return files.join(self.known(), IDENTITY)

    def snapshot(self, source_name: str, read: Callable[[SparkSession, list[str]], DataFrame], path) -> DataFrame:
        """One row: ``source_name, observed_rows, observed_fingerprint`` of all files of ``path``."""
        return self.look(read, path).agg(
            F.coalesce(F.sum("observed_rows"), F.lit(0)).alias("observed_rows"),
            F.coalesce(F.bit_xor("observed_fingerprint"), F.lit(0).cast("bigint")).alias("observed_fingerprint")
        ).select(F.lit(source_name).alias("source_name"), "observed_rows", "observed_fingerprint")
