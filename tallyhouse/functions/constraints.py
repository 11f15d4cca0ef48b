"""NOT NULL enforcement: a NULL aborts the job, as a constraint violation aborts a load.

The check lives in the projected column itself, so it runs wherever the column is
produced. It must sit in a column the sink writes: a pruned column is never evaluated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def assert_not_null(col: str, table: str = "") -> Column:
    where = f"{table}.{col}" if table else col
    c = F.col(col)
    return F.when(c.isNull(), F.raise_error(F.lit(f"NOT NULL constraint violated: {where}"))
                  ).otherwise(c).alias(col)


def not_null_columns(df: DataFrame, columns, table: str = "") -> DataFrame:
    """Wrap ``columns`` of ``df`` in NOT NULL checks, keeping column order."""
    wanted = set(columns)
    return df.select([assert_not_null(c, table) if c in wanted else F.col(c) for c in df.columns])
