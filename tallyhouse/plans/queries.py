"""The analytic query catalogue over the marts (19 queries).

Each query is a function of the mart DataFrames it reads. "Latest year" is the maximum
year of the queried table, expressed as a scalar subquery: Catalyst pushes the equality
into the scan, and on a table partitioned by year it prunes to one partition.

Ordering rules made explicit: a descending sort puts NULLs first and an ascending sort
puts them last (so a NULL ratio leads a "top" list), and every top-k has a unique
tie-breaker so that LIMIT picks the same rows on every run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tallyhouse.functions.metrics import mean
from tallyhouse.operators.ntile import ntile

TOP_K = 10


@dataclass
class Marts:
    fact: DataFrame                 # country_year_sex_age_rates
    total: DataFrame                # country_year_total_15plus
    population: DataFrame           # country_population
    with_population: DataFrame      # country_year_total_15plus_with_population


def latest_year(df: DataFrame) -> DataFrame:
    """Rows of the most recent year present in ``df``."""
    return df.filter(F.col("year") == df.agg(F.max("year")).scalar())


def _top(df: DataFrame, column: str, descending: bool, tie: list[str], cols: list[str],
         k: int = TOP_K) -> DataFrame:
    c = F.col(column)
    first = c.desc_nulls_first() if descending else c.asc_nulls_last()
    return df.orderBy(first, *[F.col(t).asc() for t in tie]).limit(k).select(*cols)


def q01(m: Marts) -> DataFrame:
    """Row counts of the fact and of the Total/15+ slice, one row."""
    return m.fact.agg(F.count(F.lit(1)).alias("country_year_sex_age_rates_rows")).select(
        "country_year_sex_age_rates_rows",
        m.total.agg(F.count(F.lit(1))).scalar().alias("country_year_total_15plus_rows"))


def q02(m: Marts) -> DataFrame:
    """Fact rows per year."""
    return (m.fact.groupBy("year").agg(F.count(F.lit(1)).alias("rows_in_fact"))
            .orderBy("year"))


def q03(m: Marts) -> DataFrame:
    """Latest year: top 10 countries by unemployment/employment ratio (Total, 15+)."""
    return _top(latest_year(m.total), "unemployment_to_employment_ratio", True, ["iso_code"],
                ["iso_code", "country", "year", "employment_rate_15plus_total",
                 "unemployment_rate_15plus_total", "unemployment_to_employment_ratio",
                 "unemployment_minus_employment"])


def q04(m: Marts, iso_code: str = "AFG") -> DataFrame:
    """Time series of one country (Total, 15+)."""
    return (m.total.filter(F.col("iso_code") == iso_code)
            .select("year", "employment_rate_15plus_total", "unemployment_rate_15plus_total",
                    "unemployment_to_employment_ratio", "unemployment_minus_employment")
            .orderBy("year"))


def q05(m: Marts) -> DataFrame:
    """Latest year: average rates by sex and age."""
    return (latest_year(m.fact).groupBy("year", "sex", "age")
            .agg(mean("employment_rate").alias("avg_employment_rate"),
                 mean("unemployment_rate").alias("avg_unemployment_rate"))
            .orderBy("sex", "age"))


def q06(m: Marts) -> DataFrame:
    """Latest year: top 10 rows of the fact by gap (unemployment - employment)."""
    return _top(latest_year(m.fact), "unemployment_minus_employment", True,
                ["iso_code", "sex", "age"],
                ["iso_code", "country", "year", "sex", "age", "unemployment_minus_employment"])


def q07(m: Marts) -> DataFrame:
    """Latest year: number of distinct countries in the fact."""
    return latest_year(m.fact).groupBy("year").agg(
        F.count_distinct("iso_code").alias("distinct_countries"))


def q08(m: Marts) -> DataFrame:
    """Per year: average rates and ratio over all countries (Total, 15+), NULLs skipped."""
    return (m.total.groupBy("year")
            .agg(mean("employment_rate_15plus_total").alias("avg_employment_rate_15plus_total"),
                 mean("unemployment_rate_15plus_total").alias("avg_unemployment_rate_15plus_total"),
                 mean("unemployment_to_employment_ratio").alias("avg_unemployment_to_employment_ratio"))
            .orderBy("year"))


def q09(m: Marts) -> DataFrame:
    """Latest year: top 10 by unemployment rate (Total, 15+)."""
    return _top(latest_year(m.total), "unemployment_rate_15plus_total", True, ["iso_code"],
                ["iso_code", "country", "year", "unemployment_rate_15plus_total",
                 "employment_rate_15plus_total"])


def q10(m: Marts) -> DataFrame:
    """Latest year: the 10 lowest employment rates (Total, 15+)."""
    return _top(latest_year(m.total), "employment_rate_15plus_total", False, ["iso_code"],
                ["iso_code", "country", "year", "employment_rate_15plus_total",
                 "unemployment_rate_15plus_total"])


def q11(m: Marts) -> DataFrame:
    """Latest year: the 10 highest employment rates (Total, 15+)."""
    return _top(latest_year(m.total), "employment_rate_15plus_total", True, ["iso_code"],
                ["iso_code", "country", "year", "employment_rate_15plus_total",
                 "unemployment_rate_15plus_total"])


def q12(m: Marts, iso_code: str = "AFG") -> DataFrame:
    """One country: unemployment rate and ratio by year (Total, 15+)."""
    return (m.total.filter(F.col("iso_code") == iso_code)
            .select("year", "unemployment_rate_15plus_total", "unemployment_to_employment_ratio")
            .orderBy("year"))


def q13(m: Marts) -> DataFrame:
    """Latest year: fact rows per (sex, age)."""
    return (latest_year(m.fact).groupBy("year", "sex", "age")
            .agg(F.count(F.lit(1)).alias("rows")).orderBy("sex", "age"))


def q14(m: Marts) -> DataFrame:
    """Latest year: top 10 by gap (Total, 15+)."""
    return _top(latest_year(m.total), "unemployment_minus_employment", True, ["iso_code"],
                ["iso_code", "country", "year", "unemployment_minus_employment",
                 "unemployment_rate_15plus_total", "employment_rate_15plus_total"])


def q15(m: Marts) -> DataFrame:
    """Row counts of the population snapshot and of the slice with population."""
    return m.population.agg(F.count(F.lit(1)).alias("country_population_rows")).select(
        "country_population_rows",
        m.with_population.agg(F.count(F.lit(1))).scalar().alias(
            "total_15plus_with_population_rows"))


def q16(m: Marts) -> DataFrame:
    """Latest year: top 10 by population."""
    return _top(latest_year(m.with_population), "population", True, ["iso_code"],
                ["iso_code", "country", "year", "population", "unemployment_rate_15plus_total",
                 "employment_rate_15plus_total"])


def q17(m: Marts) -> DataFrame:
    """Latest year: top 10 by estimated unemployed persons."""
    return _top(latest_year(m.with_population), "unemployment_persons_est", True, ["iso_code"],
                ["iso_code", "country", "year", "population", "unemployment_rate_15plus_total",
                 "unemployment_persons_est"])


def q18(m: Marts) -> DataFrame:
    """Per year: total estimated unemployed persons."""
    return (m.with_population.groupBy("year")
            .agg(F.sum("unemployment_persons_est").alias("total_unemployed_persons_est"))
            .orderBy("year"))


def q19(m: Marts, partitions: int | None = None) -> DataFrame:
    """Latest year: average unemployment rate per population quartile.

    Quartiles by NTILE(4) over population (iso_code breaks ties), computed with the
    range-partitioned ntile so no single task receives the whole year.
    """
    base = latest_year(m.with_population).select("iso_code", "population",
                                                 "unemployment_rate_15plus_total")
    quartiles = ntile(base, 4, ["population", "iso_code"], out="pop_quartile",
                      partitions=partitions)
    return (quartiles.groupBy("pop_quartile")
            .agg(mean("unemployment_rate_15plus_total").alias("avg_unemployment_rate"))
            .orderBy("pop_quartile"))


CATALOGUE = {
    "q01": q01, "q02": q02, "q03": q03, "q04": q04, "q05": q05, "q06": q06, "q07": q07,
    "q08": q08, "q09": q09, "q10": q10, "q11": q11, "q12": q12, "q13": q13, "q14": q14,
    "q15": q15, "q16": q16, "q17": q17, "q18": q18, "q19": q19,
}

# Queries that take a country code; the reference's example country is AFG.
COUNTRY_QUERIES = ("q04", "q12")
