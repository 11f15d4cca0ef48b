"""File sources: the rate CSV files and the population JSON document(s)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse import schemas


def read_rate_csv(spark: SparkSession, path, multi_line: bool = False) -> DataFrame:
    """Rate CSV files -> six text columns plus ``_pos`` (file, block, row sequence).

    * header line skipped, columns taken by position (``enforceSchema``), never inferred;
    * ``""`` is the empty string while an unquoted empty field is NULL (``nullValue`` set
      to a character that never occurs keeps the two apart);
    * doubled quotes escape a quote;
    * a row with the wrong number of fields fails the job (FAILFAST), also when a query reads
      one column or only counts: ``columnPruning`` is off, every row is parsed in full.

    Files are split. ``multi_line=True`` is the exception for producers that put line breaks
    inside quoted fields: every file is then one task. Without it such a row has the wrong
    number of fields, so it fails the job. ``_pos`` orders rows as they appear in the files.
    """
    reader = (spark.read.schema(schemas.RATE_FILE)
              .option("header", True)
              .option("enforceSchema", True)
              .option("quote", '"')
              .option("escape", '"')
              .option("multiLine", multi_line)
              .option("nullValue", "\u0000")
              .option("columnPruning", False)
              .option("mode", "FAILFAST")
              .option("encoding", "UTF-8"))
    df = reader.csv(path)
    pos = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )
    return df.select(*schemas.RATE_FILE_COLUMNS, pos.alias("_pos"))


def write_rate_csv(df: DataFrame, path: str) -> None:
    """Write six text columns as CSV files in the format ``read_rate_csv`` reads."""
    (df.select(*schemas.RATE_FILE_COLUMNS).write.mode("overwrite")
       .option("header", True).option("quote", '"').option("escape", '"')
       .csv(path))


def read_population_json(spark: SparkSession, path) -> DataFrame:
    """Population JSON documents -> one row per list element.

    Each file holds one JSON document whose top level must be a list (anything else
    fails the job). Elements are kept as VARIANT so a number 12.9 and a string "12.9"
    stay distinguishable; fields are then coerced like the API client did:
    integers kept, numbers truncated, numeric strings parsed, ``true`` -> 1,
    anything else NULL. Output: ``code, name, population, _pos`` with ``_pos`` =
    (file, 0, index in the list). One file is one task: ``split_json`` reads large ones.
    """
    docs = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"),
        F.parse_json("value").alias("doc"))
    items = F.try_variant_get("doc", "$", "array<variant>")
    checked = F.when(items.isNull(),
                     F.raise_error(F.concat(F.lit("population payload is not a list: "),
                                            F.col("file")))).otherwise(items)
    exploded = docs.select("file", F.posexplode(checked).alias("idx", "item"))
    return population_fields(exploded.select("item", F.struct(
        F.col("file"), F.lit(0).cast("bigint").alias("block"), F.col("idx").cast("bigint").alias("seq")).alias("_pos")))


def population_fields(elements: DataFrame) -> DataFrame:
    """List elements (item, _pos) -> code, name, population, _pos, coerced as above."""
    return elements.select(
        _truthy_text("item", "alpha3Code").alias("code"),
        _truthy_text("item", "name").alias("name"),
        F.try_variant_get("item", "$.population", "bigint").alias("population"), "_pos")


def _truthy_text(item: str, field: str):
    """A JSON field as text the way the API client read it: NULL when the value is
    missing or falsy (null, false, 0, "", [], {}), otherwise its text, with ``true``
    spelled ``True``."""
    value = F.try_variant_get(item, f"$.{field}", "variant")
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(item, f"$.{field}", "string")
    numeric = kind.rlike(r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)")
    falsy = (value.isNull() | (kind == "VOID")
             | ((kind == "BOOLEAN") & (text == "false"))
             | (numeric & (text.try_cast("double") == 0))
             | (text == "") | (kind.startswith("ARRAY") & (text == "[]"))
             | (kind.startswith("OBJECT") & (text == "{}")))
    return F.when(~falsy, F.when(kind == "BOOLEAN", F.lit("True")).otherwise(text))


def write_population_json(objects: DataFrame, path: str, rows_per_file: int = 50_000) -> None:
    """Write population objects as JSON list documents, ``rows_per_file`` elements each.

    A document is one file and must be built by one task, so its size is bounded by
    ``rows_per_file``; the file count grows with the input (one ``count`` decides it).
    Elements keep their ``_pos`` order inside and across files.
    """
    files = max(1, -(-objects.count() // rows_per_file))
    cols = objects.select(F.col("code").alias("alpha3Code"), "name", "population", "_pos")
    ranged = cols.repartitionByRange(files, "_pos").withColumn("_f", F.spark_partition_id())
    per_file = ranged.groupBy("_f").agg(F.sort_array(F.collect_list(F.struct(
        "_pos", F.struct("alpha3Code", "name", "population").alias("o")))).alias("l"))
    # One directory per document, named so that path order is element order.
    docs = per_file.select(F.format_string("%019d", F.col("_f")).alias("doc"),
                           F.to_json(F.col("l.o")).alias("value"))
    docs.write.mode("overwrite").partitionBy("doc").text(path)
