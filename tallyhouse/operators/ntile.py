"""NTILE(n) over a global order without funnelling all rows into one task.

``ntile(n).over(Window.orderBy(...))`` has no PARTITION BY, so Spark moves every row to a
single partition. Here the rows are range-partitioned and sorted once by Spark itself and
written to the shared scratch folder with their range and their place in it. From that one
copy the rows per range are counted (one row per range) and summed up, and the offsets give
every row its global rank. Buckets follow the SQL rule: with ``N`` rows, ``big = N div n``
and ``rem = N % n``, the first ``rem`` buckets hold ``big + 1`` rows, the rest ``big``.

The order columns are ascending with NULLs last, as ORDER BY has it in the original system,
and must form a total order (add a unique tie-breaker).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tallyhouse.session import fresh_scratch_path


def ntile(df: DataFrame, n: int, order: Sequence, out: str = "ntile",
          partitions: int | None = None) -> DataFrame:
    if n < 1:
        raise ValueError("ntile needs n >= 1")
    spark = df.sparkSession
    ranges = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in order]
    path = fresh_scratch_path(spark, "ntile")
    sorted_rows = df.repartitionByRange(ranges, *by).sortWithinPartitions(*by).withColumns({
        "_range": F.spark_partition_id(),
        "_local": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    sorted_rows.write.parquet(path)
    rows = spark.read.schema(sorted_rows.schema).parquet(path)

    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select(
        "_range",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_offset"),
        F.sum("_cnt").over(Window.partitionBy()).alias("_total"))
    # one row per range, so at most as many as the range exchange has partitions
    ranked = rows.join(F.broadcast(offsets), on="_range", how="inner")
    bucket = F.expr(f"""
        CASE WHEN (_offset + _local) < (_total % {n}) * (_total div {n} + 1)
             THEN (_offset + _local) div (_total div {n} + 1) + 1
             ELSE _total % {n}
                  + ((_offset + _local) - (_total % {n}) * (_total div {n} + 1))
                    div greatest(_total div {n}, 1) + 1
        END""")
    return ranked.withColumn(out, bucket.cast("int")).drop("_range", "_local", "_offset", "_total")
