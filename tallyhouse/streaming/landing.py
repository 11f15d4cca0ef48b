"""Incremental landing of rate files with Structured Streaming.

For deployments where rate files arrive over time: a file-stream source with the same
CSV rules as ``read_rate_csv`` picks up new files, and every micro-batch is written as
one directory of the raw table (``batch=<id>``, overwritten on replay, so a retried
batch never duplicates rows). Positions are ``(batch, file, block, seq)``: arrival order
across batches, file order within one. Staging runs on the landed table exactly as on a
batch-landed one (``stage_rates(read_landed(...), ...)``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyhouse import schemas


def rate_file_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.schema(schemas.RATE_FILE)
              .option("header", True)
              .option("enforceSchema", True)
              .option("quote", '"')
              .option("escape", '"')
              .option("multiLine", True)
              .option("nullValue", "\u0000")
              .option("columnPruning", False)
              .option("mode", "FAILFAST"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.csv(source_dir)
    return df.select(*schemas.RATE_FILE_COLUMNS,
                     F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_block"))


def _land_batch(target_dir: str):
    def land(batch: DataFrame, batch_id: int) -> None:
        pos = F.struct(F.lit(batch_id).cast("bigint").alias("batch"),
                       F.col("_file").alias("file"), F.col("_block").alias("block"),
                       F.monotonically_increasing_id().alias("seq"))
        out = batch.select(*schemas.RATE_FILE_COLUMNS,
                           F.current_timestamp().cast("timestamp_ntz").alias("loaded_at"),
                           pos.alias("_pos"))
        out.write.mode("overwrite").parquet(f"{target_dir}/batch={batch_id:012d}")
    return land


def start_rate_landing(spark: SparkSession, source_dir: str, target_dir: str,
                       checkpoint_dir: str, available_now: bool = True,
                       processing_time: str | None = None) -> StreamingQuery:
    """Start landing new files of ``source_dir`` into the raw table at ``target_dir``.

    ``available_now``: process what is there, then stop (scheduled incremental runs);
    otherwise a continuous query with ``processing_time`` triggers.
    """
    writer = (rate_file_stream(spark, source_dir).writeStream
              .foreachBatch(_land_batch(target_dir))
              .option("checkpointLocation", checkpoint_dir))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def read_landed(spark: SparkSession, target_dir: str) -> DataFrame:
    """The raw rate table landed by the stream (all batches)."""
    return spark.read.parquet(target_dir).drop("batch")
