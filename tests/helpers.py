from pyspark.sql import functions as F

SIX = ["iso_code", "country", "sex", "age", "year", "obs_value"]


def raw_rates(spark, rows):
    """Raw rate rows (six texts) in arrival order, with a ``_pos`` column."""
    data = [tuple(r) + (i,) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in SIX) + ", seq long")
    pos = F.struct(F.lit("mem").alias("file"), F.lit(0).cast("bigint").alias("block"),
                   F.col("seq").alias("seq"))
    return df.select(*SIX, pos.alias("_pos"))


def objects(spark, rows):
    data = [tuple(r) + (i,) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "code string, name string, population long, seq long")
    pos = F.struct(F.lit("mem").alias("file"), F.lit(0).cast("bigint").alias("block"),
                   F.col("seq").alias("seq"))
    return df.select("code", "name", "population", pos.alias("_pos"))
