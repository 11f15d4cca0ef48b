"""Raw landing and staging plans (validate, type, one row per natural key)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse import schemas
from tallyhouse.functions.constraints import assert_not_null
from tallyhouse.functions.validate import (
    iso3_ok,
    population_ok,
    rate_row_ok,
    typed_rate,
    typed_year,
)
from tallyhouse.operators.dedup import keep_first, keep_last


def land_rates(feed: DataFrame, loaded_at) -> DataFrame:
    """Raw rate table: the six text columns as received, the load time, the position."""
    at = loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at)
    return feed.select(*schemas.RATE_FILE_COLUMNS,
                       at.cast("timestamp_ntz").alias("loaded_at"), "_pos")


def validated_rates(raw: DataFrame, value_column: str, order: Sequence[str] = ("_pos",),
                    strict: bool = False) -> DataFrame:
    """Rows that pass every staging rule, typed; duplicates of a key still present.

    Invalid rows are dropped silently. A NULL iso_code or country in a row that is
    otherwise valid aborts the job: every valid row is an insert attempt into NOT NULL
    columns, and the constraint is checked before the key conflict is.
    """
    typed = raw.select(
        "iso_code", "country", "sex", "age",
        typed_year("year").alias("year"),
        typed_rate("obs_value", strict=strict).alias(value_column),
        *order,
    )
    valid = typed.filter(rate_row_ok("year", "sex", "age", value_column))
    # NOT NULL checks run on valid rows only, before grouping.
    return valid.select(assert_not_null("iso_code", value_column),
                        assert_not_null("country", value_column), "sex", "age",
                        "year", value_column, *order)


def stage_rates(raw: DataFrame, value_column: str, order: Sequence[str] = ("_pos",),
                strict: bool = False) -> DataFrame:
    """Validated, typed rate rows; the first valid row per (iso_code, sex, age, year) wins
    (insert-or-ignore in arrival order)."""
    valid = validated_rates(raw, value_column, order, strict)
    first = keep_first(valid, schemas.RATE_KEYS, order, ["country", value_column])
    return first.select("iso_code", "country", "sex", "age", "year", value_column)


def validate_population(objects: DataFrame) -> DataFrame:
    """API objects -> raw population rows: objects without a code, a name, or a positive
    integer population are skipped; per code the last valid object wins."""
    code, name, pop = F.col("code"), F.col("name"), F.col("population")
    valid = objects.filter(
        code.isNotNull() & (code != "") & name.isNotNull() & (name != "")
        & population_ok(pop))
    renamed = valid.select(code.alias("iso_code"), name.alias("country"), pop.alias("population"), "_pos")
    return keep_last(renamed, schemas.POPULATION_KEYS, ["_pos"], ["country", "population"])


def land_population(objects: DataFrame, loaded_at) -> DataFrame:
    at = loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at)
    return validate_population(objects).select(
        "iso_code", "country", "population", at.cast("timestamp_ntz").alias("api_loaded_at"))


def stage_population(raw_population: DataFrame) -> DataFrame:
    """Population rows with an ISO-3 shaped code and a positive population.

    The raw table already holds one row per code, so no de-duplication is needed.
    """
    return raw_population.filter(iso3_ok("iso_code") & population_ok("population")).select(
        "iso_code", "country", F.col("population").cast("bigint").alias("population"))
