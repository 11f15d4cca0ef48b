"""Mixing sources to target weights by cube-method balanced sampling.

Every source has a target number of words; its documents are taken ``floor(ratio)`` times each
plus once more for a balanced sample with inclusion probability ``frac(ratio)``, where
``ratio = target / source size``. The sample is drawn by the cube method: probabilities move
through the null space of the constraints (documents, words) so that both totals stay exactly
balanced, and every move settles one document. A move involves three undecided documents, so a
flight leaves at most two of them; each task flies over its own buckets, the leftovers (at most
two per bucket and source) fly again in larger buckets, until a landing problem of a dozen
documents per source remains, which is solved by trying its outcomes.

Defined results: null sources form one source, last in order; null or empty texts have size 0
and count as documents only; a source whose documents are all empty has target 0 and nothing is
taken; repeated rows are separate documents; an empty table gives no rows; other columns pass
through, but for those named like an added column, which it replaces.
Moves are drawn by hashing the documents and a seed, never from a task's random state, so
reruns and retried tasks agree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, numbered, sheltered, staged

BUCKET_ROWS = 20_000     # documents per flight bucket
LANDING = 12             # units of a source that the landing settles besides the last two
MERGE = 64               # buckets merged into one for the next flight
BROADCAST_ROWS = 500_000 # rows of five numbers that may be broadcast to the texts
MOST = 3.0               # a document is taken at most so often
HEAVY = 4                # documents above so many mean sizes of their source are drawn before the others


def source_targets(sources: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0)) -> DataFrame:
    """(source, source_size) with ``target``: the total shared by weight, weights repeating in
    code-point order of the sources; a target stops at MOST times its source's size and the
    excess is reshared by weight, again and again, until none is above. The level (words per
    weight) is found by a few scalar aggregates; the sources stay distributed."""
    ranked = numbered(sources, F.col("source").asc_nulls_last())
    at = F.pmod(F.col("row_no"), F.lit(len(weights))).cast("int")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), at + 1)
    table = staged(ranked.withColumn("_w", w).withColumn("_cap", F.col("source_size") * MOST)
                   .drop("row_no"), "sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while total:
        full = F.col("_cap") <= F.col("_w") * F.lit(level)
        row = table.agg(F.sum(F.when(full, F.col("_cap")).otherwise(0.0)),
                        F.sum(F.when(full, 0.0).otherwise(F.col("_w")))).first()
        if not row[1]:
            break
        new = (total - row[0]) / row[1]
        if new <= level * (1 + 1e-12):
            break
        level = new
    return table.withColumn("target", F.least("_cap", F.col("_w") * F.lit(level))).drop("_w", "_cap")


def fly(pi: np.ndarray, size: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Flight phase over the units in order: probabilities after it, at most two of them
    strictly between 0 and 1. ``draw`` holds a uniform number per unit."""
    out = pi.astype(float).copy()
    held: list[int] = []
    sizes, draws = size.tolist(), draw.tolist()
    for k in np.flatnonzero((out > 0) & (out < 1)).tolist():
        held.append(k)
        if len(held) < 3:
            continue
        a, b, c = held
        u = [sizes[c] - sizes[b], sizes[a] - sizes[c], sizes[b] - sizes[a]]
        if u[0] == u[1] == u[2] == 0:
            u = [1.0, -1.0, 0.0]
        p = [out[a], out[b], out[c]]
        up = min((1 - x) / d if d > 0 else -x / d for x, d in zip(p, u) if d)
        down = min(x / d if d > 0 else (x - 1) / d for x, d in zip(p, u) if d)
        step = up if draws[k] * (up + down) < down else -down
        held = []
        for i, x, d in zip((a, b, c), p, u):
            x += step * d
            x = 0.0 if x < 1e-9 else 1.0 if x > 1 - 1e-9 else x
            out[i] = x
            if 0 < x < 1:
                held.append(i)
    return out


def land(pi: np.ndarray, size: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Landing: LANDING units spread over the sizes sit out a last flight; of all outcomes for
    them and the two the flight leaves, the one nearest to the words still expected wins
    (ties: nearest document count)."""
    open_ = np.flatnonzero((pi > 0) & (pi < 1))
    out = pi.astype(float).copy()
    apart = open_[::-(-len(open_) // LANDING) or 1]
    flying = np.setdiff1d(open_, apart)
    out[flying] = fly(pi[flying], size[flying], draw[flying])
    at = np.flatnonzero((out > 0) & (out < 1))
    if len(at):
        picks = (np.arange(1 << len(at))[:, None] >> np.arange(len(at))) & 1
        off = picks - out[at]
        best = np.lexsort((np.abs(off.sum(axis=1)), np.abs(np.rint(off @ size[at]))))[0]
        out[at] = picks[best]
    return out


def _flights(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (bucket, source): one flight per run of equal values, in a stream; the
    undecided rows of the run at a batch's end (two at most) wait for the next batch."""
    wait: pd.DataFrame | None = None
    for batch in batches:
        if batch.empty:
            continue
        frame = batch if wait is None else pd.concat([wait, batch], ignore_index=True)
        pi = frame["_pi"].to_numpy(dtype=float).copy()
        size, draw = frame["size"].to_numpy(dtype=float), frame["_draw"].to_numpy(dtype=float)
        run = (frame["_bucket"].astype(str) + "|" + frame["_source"]).to_numpy()
        starts = np.r_[0, np.flatnonzero(run[1:] != run[:-1]) + 1, len(run)]
        for i, j in zip(starts[:-1], starts[1:]):
            pi[i:j] = fly(pi[i:j], size[i:j], draw[i:j])
        frame["_pi"] = pi
        keep = (pi > 0) & (pi < 1) & (np.arange(len(pi)) >= starts[-2])
        wait = frame[keep].reset_index(drop=True) if keep.any() else None
        yield frame[~keep]
    if wait is not None:
        yield wait


def _landings(frame: pd.DataFrame) -> pd.DataFrame:
    """All that is left of one source, BUCKET_ROWS rows at most."""
    frame = frame.sort_values(["size", "_key"], ascending=[False, True], ignore_index=True)
    frame["_pi"] = land(frame["_pi"].to_numpy(dtype=float), frame["size"].to_numpy(dtype=float),
                        frame["_draw"].to_numpy(dtype=float))
    return frame


def mix(df: DataFrame, seed: int = 5, weights: tuple[float, ...] = (1.0, 2.0, 3.0)) -> DataFrame:
    """``df`` (doc_id, text, source, ...) with size, source_size, target and copies: how often
    the mix takes each document. Texts stay where they are while the sample is drawn."""
    return sheltered(df, ("doc_id", "text", "source"), lambda rows: _mix(rows, seed, weights))


def _mix(df: DataFrame, seed: int, weights: tuple[float, ...]) -> DataFrame:
    rows = staged(df.withColumn("_rid", F.monotonically_increasing_id()), "mix_rows")
    taken = staged(mix_sized(_narrow(rows, seed, "_rid"), weights).drop("source", "doc_id"), "mix")
    if taken.count() <= BROADCAST_ROWS:      # else texts and decisions meet in a shuffle join
        taken = F.broadcast(taken)
    return rows.join(taken, "_rid").drop("_rid")


def _narrow(df: DataFrame, seed: int, *more: str) -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    return df.select(*more, "doc_id", "source", size.alias("size"),
                     F.xxhash64(F.lit(seed).cast("long"), "doc_id", "text").alias("_key"))


def mix_sized(sized: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0)) -> DataFrame:
    """The mix of narrow rows that carry ``source``, ``size`` and a hash ``_key``.

    Documents of more than HEAVY mean sizes of their source are drawn first, as a sample of their
    own: no choice of small documents at the landing could make up for one of them. The others then
    share the words that the source still wants, so their landing settles the total."""
    sized = staged(sized, "sized")
    totals = staged(sized.groupBy("source").agg(F.sum("size").alias("source_size"),
                                                F.count("*").alias("_docs")), "totals")
    docs = totals.agg(F.sum("_docs")).first()[0] or 0
    targets = source_targets(totals, weights)
    buckets = max(1, math.ceil(docs / BUCKET_ROWS))
    joined = sized.join(targets.withColumnRenamed("source", "_s"),
                        F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    names = [c for c in joined.columns if c not in ("_key", "_docs")]
    heavy = F.col("size") * F.col("_docs") > HEAVY * F.col("source_size")

    def ratio(wanted: Column, size: Column) -> Column:
        return F.greatest(F.lit(0.0), F.least(F.lit(MOST), F.coalesce(wanted / F.nullif(size, F.lit(0)), F.lit(0.0))))

    first = staged(_drawn(joined.filter(heavy), ratio(F.col("target"), F.col("source_size")), names, buckets), "heavy")
    done = first.groupBy(F.col("source").alias("_s")).agg(
        F.sum(F.col("copies") * F.col("size")).alias("_taken"), F.sum("size").alias("_size"))
    none = F.lit(0).cast("long")
    light = joined.filter(~heavy).join(done, F.col("source").eqNullSafe(F.col("_s")), "left")
    wanted = F.col("target") - F.coalesce("_taken", none)
    rest = _drawn(light, ratio(wanted, F.col("source_size") - F.coalesce("_size", none)), names, buckets)
    return first.unionByName(rest)


def _drawn(rows: DataFrame, ratio: Column, names: list[str], buckets: int) -> DataFrame:
    """``names`` of ``rows`` with copies: the cube sample at ``ratio`` copies a row on average."""
    open_ = rows.withColumn("_ratio", ratio).select(
        *names, "_key", F.floor("_ratio").cast("long").alias("_whole"),
        (F.col("_ratio") - F.floor("_ratio")).alias("_pi"),
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null")).alias("_source"),
        F.pmod("_key", F.lit(buckets)).cast("long").alias("_bucket"),
        (F.pmod(F.xxhash64("_key"), F.lit(1 << 30)) / float(1 << 30)).alias("_draw"))
    settled = []
    while buckets > 1:
        ordered = open_.repartition(min(buckets, 1 << 20), "_bucket").sortWithinPartitions(
            "_bucket", "_source", F.desc("size"), "_key")
        flown = staged(ordered.mapInPandas(_flights, ordered.schema), "flown")
        settled.append(flown.filter("_pi = 0 or _pi = 1"))
        buckets = -(-buckets // MERGE)
        open_ = flown.filter("_pi > 0 and _pi < 1").withColumn(
            "_bucket", F.pmod("_bucket", F.lit(buckets)).cast("long"))
    out = open_.groupBy("_source").applyInPandas(_landings, open_.schema)
    for more in settled:
        out = out.union(more)
    return out.withColumn("copies", F.col("_whole") + F.rint("_pi").cast("long")).select(*names, "copies")


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: every document as often as it is taken."""
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return mixed.filter("copies > 0").select(*columns, times.alias("a copy")).select(*columns)


def digest(documents: DataFrame) -> DataFrame:
    """The query: doc_id, size, source_size, target, taken."""
    return mix_sized(_narrow(documents, 5)).select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")
