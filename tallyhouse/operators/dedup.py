"""One row per natural key, chosen by arrival position.

keep_first reproduces "insert, ignore conflicts" over rows arriving in order; keep_last
reproduces "insert, overwrite on conflict" row by row. Both are one hash-partitioned
aggregation with map-side combine: every task reduces its rows to one candidate per key
before the shuffle, so a key holding a third of all rows costs one row of shuffle per
task, not a third of the data in one reducer. ``dropDuplicates`` is not used: which row
it keeps is not defined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str],
          payload: Sequence[str] | None, agg) -> DataFrame:
    keys = list(keys)
    order = list(order)
    if payload is None:
        payload = [c for c in df.columns if c not in keys and c not in order]
    payload = list(payload)
    if not payload:
        # Nothing to carry: any row of the key is the same row.
        return df.select(*keys).distinct()
    picked = agg(F.struct(*payload), F.struct(*order)).alias("_picked")
    return (df.groupBy(*keys).agg(picked)
              .select(*keys, *[F.col("_picked")[c].alias(c) for c in payload]))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               payload: Sequence[str] | None = None) -> DataFrame:
    """Per key, the whole row with the smallest ``order`` tuple."""
    return _pick(df, keys, order, payload, F.min_by)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              payload: Sequence[str] | None = None) -> DataFrame:
    """Per key, the whole row with the largest ``order`` tuple."""
    return _pick(df, keys, order, payload, F.max_by)
