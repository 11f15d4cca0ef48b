"""Derived metrics with exact decimal arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tallyhouse.schemas import PERSONS, RATE, RATIO


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def rate_ratio(unemployment, employment) -> Column:
    """unemployment / employment as DECIMAL(12,6); NULL when employment is 0.

    decimal(10,3)/decimal(10,3) is decimal(24,14) in Spark; one half-up rounding to 6 places.
    """
    return (_c(unemployment) / F.nullif(_c(employment), F.lit(0))).cast(RATIO)


def rate_gap(unemployment, employment) -> Column:
    """unemployment - employment as DECIMAL(10,3) (exact)."""
    return (_c(unemployment) - _c(employment)).cast(RATE)


def persons_estimate(population, rate) -> Column:
    """population * rate / 100 as DECIMAL(22,2), exact until the final half-up rounding."""
    return (_c(population).cast("decimal(19,0)") * _c(rate) / F.lit(100)).cast(PERSONS)


def mean(col) -> Column:
    """AVG that is exact up to one rounding: decimal SUM, then DOUBLE, then / COUNT.

    Order-independent (the decimal sum is exact), NULLs skipped, NULL on no values.
    """
    c = _c(col)
    return F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0))
