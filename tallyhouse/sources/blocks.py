"""Large text files read as separated segments in byte blocks, and state carried across blocks.

A file is split by bytes wherever it is large; every split (a block) holds whole segments, in
order. What a segment means may depend on everything before it (is a quote still open?). That
state is a prefix sum, taken in two steps: inside each block over its segments, and over the
blocks, one row each. No file is read by one task, and nothing but block rows is ever gathered.

The segments are written to the shared folder before they are counted, so both steps see the
same blocks, and a lost task costs its own segments only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyhouse.session import fresh_scratch_path

PLACE = ["file", "block", "seq"]


def segments(spark: SparkSession, path, separator: str = "\n") -> DataFrame:
    """(file, block, seq, text): the segments of the files of ``path``. Blocks are in file order
    by their first byte, segments in a block by ``seq``. Bytes are passed on as they are."""
    read = spark.read.option("lineSep", separator).text(path)
    return read.select(F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("seq"), F.col("value").alias("text"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = fresh_scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def before_in_block(value: Column) -> Column:
    """Sum of ``value`` over the segments before this one in its block."""
    earlier = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(earlier), F.lit(0).cast("bigint"))


def before_block(value: Column) -> Column:
    """Sum of ``value`` over the blocks before this one in its file; one row per block."""
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(earlier), F.lit(0).cast("bigint"))


def occurrences(text: Column, char: str) -> Column:
    """How often an ASCII character occurs in ``text``, whose bytes may be no valid UTF-8."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(char), F.lit("")))


def stitched(parts: DataFrame, glue: str) -> DataFrame:
    """Pieces (file, block, seq, text, starts) put together, from each piece with ``starts`` = 1 up to
    the next one, with ``glue`` between: (file, block, seq, text) with the place of the first. A whole
    may go on over any number of blocks; one whole is put together in one task."""
    ordered = parts.withColumn("number", before_in_block(F.col("starts")) + F.col("starts"))
    ordered = written(ordered.select(*PLACE, "text", "starts", "number"), "pieces")
    # pieces before the first start of a block belong to the last whole begun in an earlier block
    begun = ordered.groupBy("file", "block").agg(F.sum("starts").alias("begun"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("begun") > 0, F.struct(F.col("block").alias("of_block"), F.col("begun").alias("of_number"))),
                  ignorenulls=True).over(earlier)
    begun = begun.select("file", "block", last.alias("carried"))
    own = F.col("number") > 0
    owned = ordered.join(begun, ["file", "block"]).select(
        *PLACE, "text", F.when(own, F.col("block")).otherwise(F.col("carried.of_block")).alias("of_block"),
        F.when(own, F.col("number")).otherwise(F.col("carried.of_number")).alias("of_number"))
    wholes = owned.groupBy("file", "of_block", "of_number").agg(
        F.array_sort(F.collect_list(F.struct("block", "seq", "text"))).alias("pieces"))
    return wholes.select("file", F.col("pieces")[0]["block"].alias("block"), F.col("pieces")[0]["seq"].alias("seq"),
                         F.array_join("pieces.text", glue).alias("text"))
