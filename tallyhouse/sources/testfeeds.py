"""The three input feeds, derived from the benchmark tables (orders, lineitem, customer,
nation). The real inputs are two rate CSV files and a population JSON document; these
derivations produce rows of the same shape, with every validation case represented
(bad years, non-numeric and out-of-range rates, NULLs, unknown age groups, conflicting
country spellings under one key, invalid ISO codes, non-positive populations).

Each feed carries ``_pos``, the arrival position that keep-first / keep-last order by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str, columns) -> DataFrame:
    """A benchmark table pruned to ``columns``. How it is spread is left to the planner: an
    explicit repartition would keep AQE from splitting a hot key."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def _iso(nationkey: Column) -> Column:
    # 'N' followed by two letters: nation 0 -> NAA, 7 -> NAH, 24 -> NCE.
    return F.concat(F.lit("N"), F.char(F.lit(65) + F.floor(nationkey / 10)),
                    F.char(F.lit(65) + nationkey % 10))


def _obs(amount: Column, modulus: int) -> Column:
    """A rate text with three decimals taken from an amount: ``k // 1000 . k % 1000``."""
    k = F.round(amount * 100).cast("bigint") % modulus
    return F.concat(F.floor(k / 1000).cast("string"), F.lit("."),
                    F.lpad((k % 1000).cast("string"), 3, "0"))


def _iso26(key: Column) -> Column:
    """Three letters counting in base 26: 17,576 codes, so that marts grow with the data."""
    letter = lambda k: F.char(F.lit(65) + F.pmod(k, F.lit(26)))
    return F.concat(letter(F.floor(key / 676)), letter(F.floor(key / 26)), letter(key))


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nation dimension; whether it is broadcast is decided on its measured size."""
    return table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])


def order_keys(spark: SparkSession, sf_dir: str, nation: DataFrame | None = None,
               wide: bool = False) -> DataFrame:
    """One row per order with the natural key columns of both rate feeds.

    ``wide`` takes the code from the customer key instead of the nation: 17,576 codes, so
    that the rate fact grows with the data instead of saturating at 25 countries.
    """
    o = table(spark, sf_dir, "orders", [
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate",
        "o_totalprice"])
    c = table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    n = nation if nation is not None else nations(spark, sf_dir)
    cn = c.join(n, c.c_nationkey == F.col("n_nationkey"))
    ok = F.col("o_orderkey")
    joined = o.join(cn, o.o_custkey == cn.c_custkey)
    return joined.select(
        ok,
        "o_totalprice",
        (_iso26(F.col("c_custkey")) if wide else _iso(F.col("c_nationkey"))).alias("iso_code"),
        F.concat(F.col("n_name"), F.when(ok % 2 == 1, F.lit(" *")).otherwise(F.lit(""))
                 ).alias("country"),
        F.when(F.col("o_orderstatus") == "F", "Female")
         .when(F.col("o_orderstatus") == "O", "Male").otherwise("Total").alias("sex"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "15-24")
         .when(F.col("o_orderpriority") == "2-HIGH", "25+")
         .when(F.col("o_orderpriority") == "3-MEDIUM", "15+")
         .otherwise(F.col("o_orderpriority")).alias("age"),
        F.when(ok % 97 == 0, F.lit("19x5"))
         .when(ok % 89 == 0, F.lit("1899"))
         .otherwise(F.year("o_orderdate").cast("string")).alias("year"),
    )


def employment_feed(spark: SparkSession, sf_dir: str, keys: DataFrame | None = None) -> DataFrame:
    """Employment rate rows: one per order, arrival order = order key."""
    k = keys if keys is not None else order_keys(spark, sf_dir)
    ok = F.col("o_orderkey")
    obs = (F.when(ok % 7 == 0, F.lit("0"))
            .when(ok % 61 == 0, F.lit("n/a"))
            .when(ok % 67 == 0, F.lit(None).cast("string"))
            .otherwise(_obs(F.col("o_totalprice"), 110000)))
    return k.select("iso_code", "country", "sex", "age", "year", obs.alias("obs_value"),
                    F.struct(ok.alias("o_orderkey")).alias("_pos"))


def unemployment_feed(spark: SparkSession, sf_dir: str, keys: DataFrame | None = None) -> DataFrame:
    """Unemployment rate rows: one per line item, keyed by its order."""
    k = (keys if keys is not None else order_keys(spark, sf_dir)).drop("o_totalprice")
    li = table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"])
    j = li.join(k, li.l_orderkey == k.o_orderkey)
    pos = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                   "l_extendedprice", "l_quantity")
    return j.select("iso_code", "country", "sex", "age", "year",
                    _obs(F.col("l_extendedprice"), 40000).alias("obs_value"),
                    pos.alias("_pos"))


def population_objects(spark: SparkSession, sf_dir: str, nation: DataFrame | None = None) -> DataFrame:
    """Population API objects (already field-extracted): one per customer.

    Nation 24 gets a code that is not ISO-3 shaped; nation 7 (``NAH`` in the rates) a code
    that no rate has, so the inner join of the slice with population drops that country.
    """
    c = table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal"])
    n = nation if nation is not None else nations(spark, sf_dir)
    j = c.join(n, c.c_nationkey == F.col("n_nationkey"))
    nation = F.col("c_nationkey")
    code = F.when(nation == 24, F.lit("x24")).when(nation == 7, F.lit("XXH")).otherwise(_iso(nation))
    return j.select(
        code.alias("code"),
        F.col("n_name").alias("name"),
        F.round(F.col("c_acctbal") * 1000).cast("bigint").alias("population"),
        F.struct("c_custkey").alias("_pos"),
    )


def one_json_document(objects: DataFrame, path: str) -> None:
    """The objects, in order, as one file with one JSON list (written row by row, in one task)."""
    first, last = (objects.agg(f("_pos")).scalar() for f in (F.min, F.max))
    element = F.to_json(F.struct(F.col("code").alias("alpha3Code"), "name", "population"))
    text = F.concat(F.when(F.col("_pos") == first, F.lit("[")).otherwise(F.lit(", ")), element,
                    F.when(F.col("_pos") == last, F.lit("]")).otherwise(F.lit("")))
    objects.select(text.alias("value"), "_pos").coalesce(1).sortWithinPartitions("_pos").select("value").write.text(path)


def audit_run_feed(spark: SparkSession, sf_dir: str, run: str, wide: bool = False) -> DataFrame:
    """Four successive deliveries of the employment file for the audit fixture.

    A: orders whose key is not a multiple of 10; B: all; C: all, one value edited;
    D: same as C.
    """
    feed = employment_feed(spark, sf_dir, order_keys(spark, sf_dir, wide=wide))
    ok = F.col("_pos.o_orderkey")
    if run == "A":
        return feed.filter(ok % 10 != 0)
    if run == "B":
        return feed
    if run in ("C", "D"):
        return feed.withColumn("obs_value", F.when(ok == 1, F.lit("99.999"))
                               .otherwise(F.col("obs_value")))
    raise ValueError(f"unknown audit run {run!r}")
