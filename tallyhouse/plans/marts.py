"""Mart plans: rate fact, Total/15+ slice, population snapshot, slice with population."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse import schemas
from tallyhouse.functions.metrics import persons_estimate, rate_gap, rate_ratio

# The aggregate slice kept in the Total/15+ mart.
SLICE_SEX = "Total"
SLICE_AGE = "15+"

SLICE_COLUMNS = ["iso_code", "country", "year", "employment_rate_15plus_total",
                 "unemployment_rate_15plus_total", "unemployment_to_employment_ratio",
                 "unemployment_minus_employment"]


def rates_fact(stg_employment: DataFrame, stg_unemployment: DataFrame) -> DataFrame:
    """Inner join of both staged feeds on (iso_code, sex, age, year); the country comes
    from the employment side. Both inputs are aggregates on exactly these keys, so when
    they are planned together the join reuses their hash partitioning (no extra shuffle)."""
    e = stg_employment
    u = stg_unemployment.select(*schemas.RATE_KEYS, "unemployment_rate")
    j = e.join(u, on=schemas.RATE_KEYS, how="inner")
    ur, er = F.col("unemployment_rate"), F.col("employment_rate")
    return j.select(
        "iso_code", "country", "sex", "age", "year", "employment_rate", "unemployment_rate",
        rate_ratio(ur, er).alias("unemployment_to_employment_ratio"),
        rate_gap(ur, er).alias("unemployment_minus_employment"),
    )


def total_15plus(fact: DataFrame) -> DataFrame:
    """The Total / 15+ rows of the fact, one per (iso_code, year)."""
    return fact.filter((F.col("sex") == SLICE_SEX) & (F.col("age") == SLICE_AGE)).select(
        "iso_code", "country", "year",
        F.col("employment_rate").cast(schemas.RATE).alias("employment_rate_15plus_total"),
        F.col("unemployment_rate").cast(schemas.RATE).alias("unemployment_rate_15plus_total"),
        F.col("unemployment_to_employment_ratio").cast(schemas.RATIO).alias(
            "unemployment_to_employment_ratio"),
        F.col("unemployment_minus_employment").cast(schemas.RATE).alias(
            "unemployment_minus_employment"),
    )


def country_population(stg_population: DataFrame) -> DataFrame:
    """Population snapshot, one row per iso_code."""
    return stg_population.select("iso_code", "country", "population")


def total_with_population(total: DataFrame, population: DataFrame) -> DataFrame:
    """Slice joined with the population snapshot (no year in the join: one current
    snapshot applies to every year); adds estimated persons from the rates. AQE turns the
    shuffle join into a broadcast on the measured size of a side, never on a guess."""
    p = population.select("iso_code", "population")
    j = total.join(p, on="iso_code", how="inner")
    pop = F.col("population")
    return j.select(
        "iso_code", "country", "year", "population",
        "employment_rate_15plus_total", "unemployment_rate_15plus_total",
        "unemployment_to_employment_ratio", "unemployment_minus_employment",
        persons_estimate(pop, F.col("employment_rate_15plus_total")).alias("employment_persons_est"),
        persons_estimate(pop, F.col("unemployment_rate_15plus_total")).alias("unemployment_persons_est"),
    )
