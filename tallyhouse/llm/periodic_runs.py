"""Periodic runs of words by a dictionary of basic factors.

Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0 in their text. A run is a stretch of consecutive
words with smallest period q (words q apart are identical) and at least max(MIN_LENGTH, REPEATS * q)
words that no neighbouring word extends keeping q.

For every power of two m the stretches of m words get integer names: a name of 2m words is the name
of the pair of its halves. Only stretches that occur again in their text are kept. Two successive
occurrences of a name at most 2m apart propose their distance as a period; occurrences that go on at
that distance (an arithmetic progression), and neighbouring stretches with the same distance, are one
proposal. Each proposal is extended to both sides by the names, longest first, and equal stretches
are one run under their smallest period. No run is missed: for the m with q <= m < 2q its first m
words occur again q words later, and not before, as a word sequence of smallest period q meets itself
only at multiples of q.

A collapsed text keeps the first period of every run: a word is dropped if any run holds it after
the run's first q words. The words kept are joined by one space.

Documents never meet, so nothing is shuffled. Tasks take texts in Arrow batches and work on slices of
at most SLICE_WORDS words (a longer text is a slice of its own); per slice they hold one array per
power of two, of the stretches that recur.

Defined results: null and empty texts have no words, no runs and an empty collapsed text. Repeated
rows are rows of their own; empty tables give no rows. Runs come by start, then period. Other columns
pass through, but for those named like an added one (n_words, runs, collapsed), which it replaces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import SPACE, sheltered

MIN_LENGTH, REPEATS = 24, 3
SLICE_WORDS = 200_000
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class Factors:
    """Names of the stretches of 1, 2, 4, ... words that occur more than once in their document.
    ``ids``: one integer per word; a word of one document never has the id of another's."""

    def __init__(self, ids: np.ndarray):
        self.size = len(ids)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []     # positions (ascending), names
        self.ahead: list[np.ndarray] = []      # per position its next occurrence, -1 for none
        at, name = self._named(np.arange(self.size), ids)
        while len(at):
            m = 1 << (len(self.levels) - 1)
            half = np.searchsorted(at, at + m)
            half[half == len(at)] = 0
            both = at[half] == at + m
            at, name = self._named(at[both], name[both] * (name.max() + 1) + name[half[both]])

    def _named(self, at: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(at):
            return at, key
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        again = np.r_[False, same] | np.r_[same, False]
        following = np.full(len(at), -1)
        following[order[:-1][same]] = at[order[1:][same]]
        name = np.empty(len(at), np.int64)
        name[order] = np.cumsum(np.r_[True, ~same])
        recurs = np.zeros(len(at), bool)
        recurs[order[again]] = True
        at, name = at[recurs], name[recurs]
        if len(at):
            self.levels.append((at, name))
            self.ahead.append(following[recurs])
        return at, name

    def same(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the stretches of this level at ``a`` and ``b`` (a < b) are equal."""
        at, name = self.levels[level]
        i, j = np.searchsorted(at, a), np.searchsorted(at, b)
        i[i == len(at)] = 0
        j[j == len(at)] = 0
        return (at[i] == a) & (at[j] == b) & (name[i] == name[j])

    def proposals(self) -> tuple[np.ndarray, np.ndarray]:
        """(position, period) of the first occurrence of every progression."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for level, ((at, _), ahead) in enumerate(zip(self.levels, self.ahead)):
            gap = np.where(ahead >= 0, ahead - at, 0)
            gap[gap > 2 << level] = 0
            goes_on = np.zeros(len(at), bool)      # reached from an occurrence at the same distance
            linked = gap > 0
            goes_on[np.searchsorted(at, ahead[linked])] = gap[np.searchsorted(at, ahead[linked])] == gap[linked]
            beside = np.r_[False, (at[1:] == at[:-1] + 1) & (gap[1:] == gap[:-1])]
            first = linked & ~goes_on & ~beside
            found.append((at[first], gap[first]))
        return tuple(np.concatenate(c) for c in zip(*found))

    def runs(self, min_length: int, repeats: int) -> np.ndarray:
        """Rows (start, length, period) by start, then period; starts count over the slice."""
        at, period = self.proposals()
        left, right = at.copy(), at.copy()       # words left..right equal those one period on
        for step in (1, -1):
            for level in range(len(self.levels) - 1, -1, -1):
                m, going = 1 << level, np.arange(len(at))
                while len(going):
                    a = right[going] if step > 0 else left[going] - m
                    going = going[self.same(level, a, a + period[going])]
                    if step > 0:
                        right[going] += m
                    else:
                        left[going] -= m
        length = right - left + period
        keep = length >= np.maximum(min_length, repeats * period)
        rows = np.unique(np.stack([left, length, period], axis=1)[keep], axis=0)
        return rows[np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)][:len(rows)]]


def find(texts: list[list], min_length: int = MIN_LENGTH, repeats: int = REPEATS) -> list[np.ndarray]:
    """The runs of every word list."""
    ids: list[int] = []
    starts = [0]
    for words in texts:
        known: dict = {}
        base = len(ids)
        ids += [base + known.setdefault(w, len(known)) for w in words]
        starts.append(len(ids))
    runs = Factors(np.array(ids, np.int64)).runs(min_length, repeats)
    cut = np.searchsorted(runs[:, 0], starts)
    return [runs[a:b] - [s, 0, 0] for a, b, s in zip(cut, cut[1:], starts)]


def collapse(words: list, runs: np.ndarray) -> list:
    """The words that no run holds after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0)]


def _slices(lists: Iterator[list]) -> Iterator[list[list]]:
    held, size = [], 0
    for words in lists:
        if held and size + len(words) > SLICE_WORDS:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


def periodic(documents: DataFrame, min_length: int = MIN_LENGTH, repeats: int = REPEATS,
             text_out: bool = True) -> DataFrame:
    """``documents`` (without text if not ``text_out``) with n_words, runs (start, length, period)
    and collapsed. ``repeats`` is 3 or more."""
    if repeats < 3:
        raise ValueError("runs of fewer than three periods are not all proposed")

    def rows(df: DataFrame) -> DataFrame:
        # bytes: words are cut at ASCII white space only, which is what bytes.split does
        coded = df.withColumn("text", F.col("text").cast("binary"))
        keep = [c for c in coded.columns if text_out or c != "text"]
        added = StructType.fromDDL(f"n_words bigint, runs {RUNS}, collapsed binary")
        schema = StructType([coded.schema[c] for c in keep] + added.fields)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("text"))
                counts, found, kept = [], [], []
                for part in _slices((t.as_py() or b"").split() for t in texts):
                    for words, r in zip(part, find(part, min_length, repeats)):
                        counts.append(len(words))
                        found.append(r)
                        kept.append(b" ".join(collapse(words, r)))
                flat = np.concatenate([np.zeros((0, 3), np.int64), *found])
                offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
                runs = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(
                    [pa.array(np.ascontiguousarray(c)) for c in flat.T], fields=list(_RUN)))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array(counts, pa.int64()), runs, pa.array(kept, pa.binary())],
                    [*keep, "n_words", "runs", "collapsed"])

        out = coded.mapInArrow(run, schema)
        return out.withColumns({c: F.col(c).cast("string") for c in ("text", "collapsed") if c in out.columns})

    return sheltered(documents, ("text",), rows)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length/period; ties: smallest start, then period."""
    def better(a: Column, b: Column) -> Column:
        more, less = a["length"] * b["period"], b["length"] * a["period"]
        return ((more > less) | ((more == less) & ((a["start"] < b["start"]) | (
            (a["start"] == b["start"]) & (a["period"] < b["period"])))))

    return F.get(F.reduce(runs, F.slice(runs, 1, 1), lambda best, r: F.when(
        better(r, F.get(best, F.lit(0))), F.array(r)).otherwise(best)), F.lit(0))


def planted(documents: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document (by crc32 of its doc_id) repeats a stretch of its
    words up to its end: with h the checksum and g = floor(h / 10), each word i >= a becomes word
    a + (i - a) % p, a = g % n, p = 1 + floor((n - a) / (3 + g % 8))."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = documents.select("doc_id", "text", F.when(h % 10 == 0, F.floor(h / 10)).alias("g"))
    words = F.array_remove(F.split("text", SPACE), "")
    cut = rows.select("doc_id", "text", "g", F.when(F.col("g").isNotNull(), words).alias("w"))
    n = F.size("w")
    a = (F.col("g") % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int")
    # the positions are columns of their own: the loop below only reads them
    sized = cut.select("doc_id", "text", "w", F.when(n > 0, a).alias("a"), F.when(n > 0, p).alias("p"))
    again = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(
        F.get("w", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return sized.select("doc_id", F.when(F.col("p").isNotNull(), F.array_join(again, " ")).otherwise(
        F.col("text")).alias("text"))


def digest(documents: DataFrame) -> DataFrame:
    """The query: number of runs, the strongest run, checksums of all runs and of the collapsed text."""
    found = periodic(planted(documents), text_out=False).withColumn("best", strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    best = {c: F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")}
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *best.values(),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
