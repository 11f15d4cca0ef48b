from decimal import Decimal

from pyspark.sql import functions as F

from tallyhouse.functions.metrics import persons_estimate, rate_gap, rate_ratio


def test_ratio_gap_persons(spark):
    df = spark.createDataFrame(
        [(Decimal("0.000"), Decimal("5.000"), 10), (Decimal("0.001"), Decimal("100.000"), 7),
         (Decimal("3.000"), Decimal("1.000"), 3)],
        "e decimal(10,3), u decimal(10,3), p long")
    out = df.select(rate_ratio("u", "e").alias("r"), rate_gap("u", "e").alias("g"),
                    persons_estimate(F.col("p"), F.col("u")).alias("n")).collect()
    assert out[0].r is None and out[0].g == Decimal("5.000")
    assert out[1].r == Decimal("100000.000000")
    assert out[2].r == Decimal("0.333333") and out[2].g == Decimal("-2.000")
    assert out[2].n == Decimal("0.03")
    assert out[1].n == Decimal("7.00")
    schema = {f.name: f.dataType.simpleString() for f in
              df.select(rate_ratio("u", "e").alias("r"), rate_gap("u", "e").alias("g"),
                        persons_estimate(F.col("p"), F.col("u")).alias("n")).schema.fields}
    assert schema == {"r": "decimal(12,6)", "g": "decimal(10,3)", "n": "decimal(22,2)"}


def test_ratio_half_up(spark):
    # 2/3 = 0.6666666.. -> 0.666667 ; 1/8 = 0.125 exactly
    df = spark.createDataFrame([(Decimal("3.000"), Decimal("2.000")), (Decimal("8.000"), Decimal("1.000"))],
                               "e decimal(10,3), u decimal(10,3)")
    out = [r.r for r in df.select(rate_ratio("u", "e").alias("r")).collect()]
    assert out == [Decimal("0.666667"), Decimal("0.125000")]
