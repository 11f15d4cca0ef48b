"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Rows are numbered 0..N-1 in key order. A keyed Feistel network permutes the grid a x b, the
smallest near-square with a*b >= N; positions outside 0..N-1 walk on along their cycle until
they fall inside. ``shard = position mod shards`` and ``slot = position div shards``, so both
can be computed from (row number, N, seed) alone, without reading data, and the same inputs
give the same shuffle on every run. Shard counts differ by one row at most, whatever the keys.

Defined results: an empty table gives no rows; rows with equal or null keys are all kept (nulls
first, ties in the order of the tie columns; identical rows are interchangeable); other columns
pass through, but for those named like an added column, which it replaces.
"""

from __future__ import annotations

import math
import struct

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, sheltered, staged

ROUNDS = 6
STEPS = 8            # cycle steps inside one expression; the loop in ``shard`` does the rest


def grid(n: int) -> tuple[int, int]:
    """Sides a, b of the smallest near-square grid with a*b >= n."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-n // a))


def _network(x: Column, n: int, seed: int) -> Column:
    """One pass of the Feistel network over the grid (additions modulo the sides)."""
    a, b = grid(n)

    def turn(half: Column, other: Column, r: Column, side: int) -> Column:
        key = F.xxhash64(F.lit(seed).cast("long"), r, other)
        return F.pmod(half + F.pmod(key, F.lit(side)), F.lit(side))

    def one(state: Column, r: Column) -> Column:
        left, right = state["l"], state["r"]
        even = F.pmod(r, F.lit(2)) == 0
        return F.struct(F.when(even, turn(left, right, r, a)).otherwise(left).alias("l"),
                        F.when(even, right).otherwise(turn(right, left, r, b)).alias("r"))

    start = F.struct(((x - F.pmod(x, F.lit(b))) / b).cast("long").alias("l"),
                     F.pmod(x, F.lit(b)).cast("long").alias("r"))
    rounds = F.array(*[F.lit(r).cast("long") for r in range(ROUNDS)])
    return F.aggregate(rounds, start, one, lambda s: s["l"] * F.lit(b) + s["r"])


def _walk(x: Column, n: int, seed: int, first: bool) -> Column:
    """Up to STEPS steps along the cycle, stopping at the first position below n."""
    steps = F.sequence(F.lit(0), F.lit(STEPS - 1))
    go = lambda p, i: (p >= n) | (F.lit(first) & (i == 0))
    return F.aggregate(steps, x, lambda p, i: F.when(go(p, i), _network(p, n, seed)).otherwise(p))


def position_of(row_no: int, n: int, seed: int) -> int:
    """The position of one row, computed without any data (same law as the columns)."""
    import xxhash

    a, b = grid(n)

    def key(r: int, v: int) -> int:
        h = 42
        for part in (seed, r, v):
            h = xxhash.xxh64_intdigest(struct.pack("<q", part), h)
        return h - (1 << 64) if h >> 63 else h

    p = row_no
    while True:
        left, right = divmod(p, b)
        for r in range(ROUNDS):
            if r % 2 == 0:
                left = (left + key(r, right) % a) % a
            else:
                right = (right + key(r, left) % b) % b
        p = left * b + right
        if p < n:
            return p


def shard(df: DataFrame, shards: int = 8, seed: int = 17, key: str = "doc_id",
          ties: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with row_no, position, shard and slot."""
    return sheltered(df, (key, *ties), lambda rows: _shard(rows, shards, seed, key, ties))


def _shard(df: DataFrame, shards: int, seed: int, key: str, ties: tuple[str, ...]) -> DataFrame:
    rows = numbered(df, F.col(key).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in ties])
    n = rows.count()
    placed = rows.withColumn("position", _walk(F.col("row_no"), n, seed, True) if n
                             else F.lit(0).cast("long"))
    placed = staged(placed, "placed")
    while not placed.filter(F.col("position") >= n).isEmpty():
        placed = staged(placed.withColumn("position", _walk(F.col("position"), n, seed, False)),
                        "placed")
    pos, k = F.col("position"), F.lit(shards)
    return (placed.withColumn("shard", F.pmod(pos, k).cast("int"))
            .withColumn("slot", ((pos - F.pmod(pos, k)) / k).cast("long")))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order within each file."""
    (sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def digest(documents: DataFrame, shards: int = 8, seed: int = 17) -> DataFrame:
    """The query: size (UTF-8 bytes plus 1; null text: 1), crc32 of the UTF-8 bytes (null: of no
    bytes, 0), and each document's place under law ``rows``."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    narrow = documents.select("doc_id", (F.length(raw) + 1).cast("long").alias("size"),
                              F.crc32(raw).alias("text_crc32"))
    return shard(narrow, shards, seed, ties=("text_crc32", "size")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_no", "position")
