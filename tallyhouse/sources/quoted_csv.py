"""Rate CSV files with line breaks inside quoted fields, split; bytes checked as strictly as COPY.

A physical line begins a record exactly when the quotes before it in its file are even in number
(a doubled quote counts twice, so it changes nothing). Quotes are counted per line and summed per
block; the parity at the start of a block is a prefix sum over the blocks. Blocks without an odd
line, which begin outside a field, are parsed line by line as they are. Only the lines of the other
blocks are put in order inside their block, and only records of several lines are stitched, also
across blocks.

The run fails on: a blank line between records, bytes that are not UTF-8, a NUL character, a field
that is still open at the end of its file, a wrong number of fields. Records end with LF or CRLF; a
quote inside an unquoted field opens a quotation, as it does for COPY.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyhouse import schemas
from tallyhouse.sources import blocks as B

QUOTE = '"'
OPTIONS = {"quote": QUOTE, "escape": QUOTE, "nullValue": "\u0000", "mode": "FAILFAST", "multiLine": "true",
           "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _lines(spark: SparkSession, path) -> DataFrame:
    """Physical lines with the parity of their quotes."""
    lines = B.segments(spark, path)
    return lines.withColumn("odd", (B.occurrences(F.col("text"), QUOTE) % 2).cast("int"))


def _block_rows(lines: DataFrame) -> DataFrame:
    """One row per block: its first line, whether it begins inside a field, whether its lines are
    all records of their own, and whether the file ends inside a field."""
    sums = lines.groupBy("file", "block").agg(F.sum("odd").alias("odd_lines"), F.min("seq").alias("first_seq"))
    whole = Window.partitionBy("file")
    return sums.select("file", "block", "first_seq", (B.before_block(F.col("odd_lines")) % 2).alias("inside"),
                       "odd_lines", (F.sum("odd_lines").over(whole) % 2 == 1).alias("unclosed"))


def _fail_if(bad: Column, message: str, value: Column) -> Column:
    return F.when(bad, F.raise_error(F.concat(F.lit(message + " in "), F.col("file"))).cast(
        "string")).otherwise(value)


def _records(torn: DataFrame) -> DataFrame:
    """Records of the blocks that need it: (file, block, seq, text) of their first line."""
    ordered = torn.withColumn("quotes", F.col("inside") + B.before_in_block(F.col("odd")))
    starts = (F.col("quotes") % 2 == 0).cast("int")
    ordered = B.written(ordered.select(*B.PLACE, "text", "odd", starts.alias("starts")), "csv-torn")
    single = (F.col("starts") == 1) & (F.col("odd") == 0)
    return ordered.filter(single).select(*B.PLACE, "text").unionByName(B.stitched(ordered.filter(~single), "\n"))


def csv_records(spark: SparkSession, path) -> DataFrame:
    """(file, block, seq, text): every record of the files but their headers, checked."""
    lines = _lines(spark, path)
    bad = ~F.is_valid_utf8("text") | F.contains(F.col("text"), F.lit("\u0000"))
    lines = B.written(lines.withColumn("text", _fail_if(bad, "bytes that are not UTF-8 text", F.col("text"))), "csv-lines")
    rows = B.written(_block_rows(lines), "csv-blocks")
    placed = lines.join(rows, ["file", "block"])
    torn = (F.col("inside") == 1) | (F.col("odd_lines") > 0)
    plain = placed.filter(~torn).select(*B.PLACE, "text")
    broken = placed.filter(torn).select(
        *B.PLACE, "odd", "inside", _fail_if(F.col("unclosed"), "a quoted field is not closed", F.col("text")).alias("text"))
    records = plain.unionByName(_records(broken)) if not rows.filter(torn).isEmpty() else plain
    heads = rows.filter("block = 0").select("file", "block", F.col("first_seq").alias("seq"))
    body = records.join(heads, B.PLACE, "left_anti").withColumn("text", F.regexp_replace("text", "\r\\z", ""))
    return body.withColumn("text", _fail_if(F.col("text") == "", "a blank line", F.col("text")))


def read_quoted_csv(spark: SparkSession, path) -> DataFrame:
    """Rate CSV files -> six text columns plus ``_pos``, as ``read_rate_csv`` gives them, but files
    with line breaks inside quoted fields are split too, and bad bytes fail the run."""
    fields = F.from_csv(F.col("text"), schemas.RATE_FILE.toDDL(), OPTIONS)
    # outer: the filter that an inner generator brings along would parse every record twice
    return csv_records(spark, path).select(F.struct(*B.PLACE).alias("_pos"), F.inline_outer(F.array(fields))).select(
        *schemas.RATE_FILE_COLUMNS, "_pos")


def csv_defects(spark: SparkSession, path) -> DataFrame:
    """What would fail a run, per file and without failing: lines, records (the header included),
    blank_records, invalid_lines (not UTF-8, or NUL), unclosed (ends inside a field)."""
    lines = _lines(spark, path)
    valid = F.is_valid_utf8("text") & ~F.contains(F.col("text"), F.lit("\u0000"))
    lines = B.written(lines.select(*B.PLACE, "odd", valid.alias("valid"), F.col("text").isin("", "\r").alias("blank")), "csv-lines")
    rows = _block_rows(lines)
    inside = (F.col("inside") + B.before_in_block(F.col("odd"))) % 2
    starts = (inside == 0).cast("int")
    marked = lines.join(rows, ["file", "block"]).select("file", "valid", "blank", "unclosed", starts.alias("starts"))
    return marked.groupBy("file").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("starts").alias("records"),
        F.count(F.when(F.col("blank") & (F.col("starts") == 1), 1)).alias("blank_records"),
        F.count(F.when(~F.col("valid"), 1)).alias("invalid_lines"), F.any_value("unclosed").alias("unclosed"))
