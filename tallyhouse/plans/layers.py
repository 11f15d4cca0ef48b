"""All warehouse layers as one lazily composed set of DataFrames.

``build_layers`` wires feeds -> raw -> staging -> marts without running anything; the
pipeline writes these plans, and the query catalogue can run on them directly.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.plans import marts as M
from tallyhouse.plans import staging as S
from tallyhouse.plans.queries import Marts
from tallyhouse.session import fresh_scratch_path
from tallyhouse.sources import testfeeds


@dataclass
class Feeds:
    employment: DataFrame           # six text columns + _pos
    unemployment: DataFrame         # six text columns + _pos
    population_objects: DataFrame   # code, name, population, _pos


@dataclass
class Layers:
    raw_employment: DataFrame
    raw_unemployment: DataFrame
    raw_population: DataFrame
    stg_employment: DataFrame
    stg_unemployment: DataFrame
    stg_population: DataFrame
    fact: DataFrame
    total: DataFrame
    population: DataFrame
    with_population: DataFrame

    def marts(self) -> Marts:
        return Marts(self.fact, self.total, self.population, self.with_population)


FIXED_RUN_TS = dt.datetime(2025, 1, 1, 0, 0, 0)


def feeds_from_tables(spark: SparkSession, sf_dir: str, wide: bool = False) -> Feeds:
    nation = testfeeds.nations(spark, sf_dir)
    keys = testfeeds.order_keys(spark, sf_dir, nation, wide)  # one plan shared by both rate feeds
    return Feeds(testfeeds.employment_feed(spark, sf_dir, keys),
                 testfeeds.unemployment_feed(spark, sf_dir, keys),
                 testfeeds.population_objects(spark, sf_dir, nation))


def build_layers(feeds: Feeds, loaded_at=FIXED_RUN_TS, strict: bool = False) -> Layers:
    raw_e = S.land_rates(feeds.employment, loaded_at)
    raw_u = S.land_rates(feeds.unemployment, loaded_at)
    raw_p = S.land_population(feeds.population_objects, loaded_at)
    stg_e = S.stage_rates(raw_e, "employment_rate", strict=strict)
    stg_u = S.stage_rates(raw_u, "unemployment_rate", strict=strict)
    stg_p = S.stage_population(raw_p)
    fact = M.rates_fact(stg_e, stg_u)
    total = M.total_15plus(fact)
    pop = M.country_population(stg_p)
    with_pop = M.total_with_population(total, pop)
    return Layers(raw_e, raw_u, raw_p, stg_e, stg_u, stg_p, fact, total, pop, with_pop)


_WRITTEN: dict[tuple, Marts] = {}


def written_marts(spark: SparkSession, sf_dir: str, wide: bool = False) -> Marts:
    """The marts of the benchmark feeds, written once per session and table folder: each
    mart is computed from the one before it as written, and queries read pruned scans."""
    from tallyhouse.sources.warehouse import MART, Warehouse

    key = (spark.sparkContext.applicationId, sf_dir, wide, spark.conf.get("spark.sql.shuffle.partitions"))
    if key not in _WRITTEN:
        wh = Warehouse(spark, fresh_scratch_path(spark, "marts"))

        def write(df: DataFrame, table: str) -> DataFrame:
            wh.write(df, "lazy", MART, table)
            return wh.read(MART, table, "lazy", schema=df.schema)

        L = build_layers(feeds_from_tables(spark, sf_dir, wide))
        fact = write(L.fact, "country_year_sex_age_rates")
        total = write(M.total_15plus(fact), "country_year_total_15plus")
        pop = write(L.population, "country_population")
        _WRITTEN[key] = Marts(fact, total, pop, write(
            M.total_with_population(total, pop), "country_year_total_15plus_with_population"))
    return _WRITTEN[key]


def layers_from_tables(spark: SparkSession, sf_dir: str, strict: bool = False) -> Layers:
    return build_layers(feeds_from_tables(spark, sf_dir), strict=strict)
