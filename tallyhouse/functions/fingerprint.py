"""Order-free content fingerprints of a table: COUNT(*) plus XOR of 64-bit row hashes.

XOR makes the fingerprint independent of row order and partitioning and lets it be
computed with partial aggregation (no row is shuffled). Pairs of identical rows cancel;
the row count taken in the same pass is the guard for that, as in the reference design.
Columns are joined with ``concat_ws('|', ...)``, which skips NULLs.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def row_text(*cols) -> Column:
    return F.concat_ws("|", *[_c(c).cast("string") for c in cols])


def row_hash(*cols, method: str = "xxhash64") -> Column:
    """64-bit hash of one row's text.

    ``xxhash64``: fast default. ``md5``: the first 15 hex digits of the MD5 as BIGINT,
    a portable variant other engines can reproduce (used for cross-engine checks).
    """
    text = row_text(*cols)
    if method == "xxhash64":
        return F.xxhash64(text)
    if method == "md5":
        return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    raise ValueError(f"unknown hash method {method!r}")


def fingerprint_agg(*cols, method: str = "xxhash64", where: Column | None = None) -> Column:
    """Aggregate: XOR of row hashes (of the rows that meet ``where``), 0 for an empty input."""
    h = row_hash(*cols, method=method)
    return F.coalesce(F.bit_xor(h if where is None else F.when(where, h)), F.lit(0).cast("bigint"))
