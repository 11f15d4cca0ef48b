"""Validation and typing rules of the staging layer.

The rules are expressed once as columns. Casts are ``try_cast`` so that Catalyst may
reorder or push conjuncts freely (in ANSI mode a plain cast of a bad value raises, and
"regex first, then cast" is not an evaluation order Spark promises). Anchors use ``\\z``:
Java's ``$`` also matches before a final line break, so ``'2020\\n'`` would pass.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tallyhouse.schemas import RATE

# Fixed values of the data contract.
YEAR_PATTERN = r"^[0-9]{4}\z"
RATE_PATTERN = r"^([0-9]+)([.][0-9]+)?\z"
ISO3_PATTERN = r"^[A-Z]{3}\z"
SEX_VALUES = ("Male", "Female", "Total")
AGE_VALUES = ("15+", "15-24", "25+")
YEAR_MIN, YEAR_MAX = 1991, 2025
RATE_MIN, RATE_MAX = 0, 100


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def year_text_ok(year) -> Column:
    return _c(year).rlike(YEAR_PATTERN)


def rate_text_ok(value) -> Column:
    return _c(value).rlike(RATE_PATTERN)


def typed_year(year) -> Column:
    """Text year -> INT, NULL when the text is not exactly four digits."""
    y = _c(year)
    return F.when(year_text_ok(y), y.try_cast("int"))


def typed_rate(value, strict: bool = False) -> Column:
    """Text rate -> DECIMAL(10,3) rounded half-up, NULL when not a plain decimal.

    A value that passes the pattern but does not fit DECIMAL(10,3) (``'99999999'``) is
    NULL, so the row is rejected; with ``strict=True`` it aborts the job instead.
    """
    v = _c(value)
    if strict:
        converted = v.try_cast(RATE)
        converted = F.when(converted.isNull(),
                           F.raise_error(F.concat(F.lit("rate out of range: "), v))
                           ).otherwise(converted)
        return F.when(rate_text_ok(v), converted)
    return F.when(rate_text_ok(v), v.try_cast(RATE))


def year_in_range(year_int) -> Column:
    return _c(year_int).between(YEAR_MIN, YEAR_MAX)


def rate_in_range(rate) -> Column:
    """Range check on the already rounded value (``100.0004`` -> 100.000 passes)."""
    return _c(rate).between(RATE_MIN, RATE_MAX)


def sex_ok(sex) -> Column:
    return _c(sex).isin(*SEX_VALUES)


def age_ok(age) -> Column:
    return _c(age).isin(*AGE_VALUES)


def rate_row_ok(year_int, sex, age, rate) -> Column:
    """Whole staging predicate on typed columns; for a filter, which drops NULL as well as
    false, so the plain conjuncts can be pushed into the scan."""
    return year_in_range(year_int) & sex_ok(sex) & age_ok(age) & rate_in_range(rate)


def iso3_ok(iso_code) -> Column:
    return _c(iso_code).rlike(ISO3_PATTERN)


def population_ok(population) -> Column:
    return _c(population) > 0
