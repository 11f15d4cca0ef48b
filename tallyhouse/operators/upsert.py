"""Insert-or-ignore and insert-or-update of a source DataFrame into a target table.

Both are plain relational plans (anti join + union, full outer join), so they partition
on the keys and scale like any join; the result is written as a new table version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyhouse.operators.dedup import keep_first, keep_last


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  order: Sequence[str]) -> DataFrame:
    """Rows of ``source`` whose key is new are added (first by ``order`` wins);
    keys already in ``target`` keep the target row."""
    keys = list(keys)
    cols = target.columns
    first = keep_first(source, keys, order, [c for c in cols if c not in keys])
    new_rows = first.join(target.select(*keys), on=keys, how="left_anti")
    return target.unionByName(new_rows.select(*cols))


def _unique_source(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source with a check that no key occurs twice (one statement may not update a row
    twice). The check is a filter on the aggregate, which no column pruning removes: a count
    of the result, or an update of no column, runs it as well."""
    others = [c for c in source.columns if c not in keys]
    agg = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.any_value(c).alias(c) for c in others])
    once = F.when(F.col("_n") > 1,
                  F.raise_error(F.lit("upsert source holds a key more than once")).cast("boolean")
                  ).otherwise(F.lit(True))
    return agg.filter(once).select(*keys, *others, F.lit(True).alias("_src"))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           update_cols: Sequence[str]) -> DataFrame:
    """Insert new keys; for existing keys overwrite ``update_cols`` from the source and
    keep the target's value in every other column."""
    keys = list(keys)
    update_cols = set(update_cols)
    cols = target.columns
    s = _unique_source(source.select(*cols), keys).alias("s")
    t = target.select(*cols, F.lit(True).alias("_tgt")).alias("t")
    joined = t.join(s, on=keys, how="full_outer")
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col(c))
        elif c in update_cols:
            out.append(F.when(F.col("s._src").isNotNull(), F.col(f"s.{c}"))
                       .otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(F.col("t._tgt").isNotNull(), F.col(f"t.{c}"))
                       .otherwise(F.col(f"s.{c}")).alias(c))
    return joined.select(*out)


def upsert_ordered(target: DataFrame, source: DataFrame, keys: Sequence[str],
                   order: Sequence[str]) -> DataFrame:
    """Row-by-row insert-or-update: the last source row per key (by ``order``) wins."""
    keys = list(keys)
    cols = target.columns
    last = keep_last(source, keys, order, [c for c in cols if c not in keys])
    return upsert(target, last, keys, [c for c in cols if c not in keys])
