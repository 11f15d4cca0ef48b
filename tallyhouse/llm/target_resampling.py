"""Target-distribution importance resampling over hashed word n-grams.

Features are all runs of 1 to GRAMS consecutive words of a text, joined by one space, repeats counted;
a feature's bucket is its unsigned crc32 modulo BUCKETS. A bucket's gain is the logarithm of its share
among the target's features over its share among all documents' (both smoothed by one), in floored
thousandths; a document's weight is the sum of the gains of its features. Gumbel noise from a keyed
hash of the doc_id turns the weights into scores whose highest ones are a draw without replacement.

Checksums come from a position table. Without its start and end constants a crc32 is linear: it is
the XOR, over the bytes of the span, of what that byte contributes at its distance from the end. The
table holds these contributions for SPAN distances; per slice of text they are looked up for all bytes
of all features and XORed per feature by ``bitwise_xor.reduceat``. A constant per length completes the
checksum. Longer spans are cut into blocks of SPAN bytes from their end, and the blocks folded in
pairs: the left one advanced by the length of the right one, tables for powers of two bytes doing that.

Words: A-Z lower-cased, then runs of 0-9, a-z and all characters beyond ASCII.

Corpus counts cover all rows. Buckets are computed once per text and written to the shared folder
(two bytes a feature); counts, gains and weights read them there. BUCKETS numbers are the only thing
that the driver and every task hold. Ranks come from one range exchange of ids and scores. Tasks work
on slices of about SLICE_BYTES of text, and look up at most GATHER bytes at a time.

Defined results: null and empty texts have no features, weight 0 and are never drawn; a null doc_id
counts as an empty one for the noise and comes last among ties; repeated rows are rows of their own
(their order among themselves is that of their text's hash, and identical rows are interchangeable);
very long texts and words are taken whole; empty tables give no rows, an empty target gains by the
smoothing alone. Other columns pass through, but for those named like an added one (n_features, weight,
score, rank), which it replaces.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import numbered, sheltered, staged

GRAMS = 3
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 5
SEED = 42
SPAN = 64                   # distances in the position table; a power of two
SLICE_BYTES = 1 << 17
GATHER = 1 << 18
POLYNOMIAL = 0xEDB88320     # crc32, reflected
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
FOLDED = bytes.maketrans(bytes(range(0x41, 0x5B)) + SEPARATORS, bytes(range(0x61, 0x7B)) + b" " * len(SEPARATORS))


class PositionTable:
    """crc32 of many spans of one buffer."""

    def __init__(self, span: int = SPAN):
        self.span = span
        byte = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(POLYNOMIAL), byte >> 1).astype(np.uint32)
        self.byte = byte
        rows = [byte]
        while len(rows) < span:      # one zero byte further from the end
            rows.append(byte[rows[-1] & 0xFF] ^ (rows[-1] >> 8))
        self.table = np.stack(rows)
        # advance by 2**j zero bytes, as four tables of 256 for the bytes of the register
        low = np.arange(256, dtype=np.uint32)
        one = np.stack([byte[(low << 8 * k) & 0xFF] ^ (low << 8 * k) >> 8 for k in range(4)])
        self.steps = [one]
        for _ in range(40):
            self.steps.append(np.stack([self.advance(t, len(self.steps) - 1) for t in self.steps[-1]]))
        self.constants = self.constant(np.arange(span + 1))

    def advance(self, register: np.ndarray, j: int) -> np.ndarray:
        """The registers after 2**j more zero bytes."""
        t = self.steps[j]
        return (t[0][register & 0xFF] ^ t[1][register >> 8 & 0xFF] ^ t[2][register >> 16 & 0xFF] ^ t[3][register >> 24])

    def constant(self, length: np.ndarray) -> np.ndarray:
        """What start and end values add to a span of each length: the checksum of as many zeros."""
        register = np.full(len(length), 0xFFFFFFFF, np.uint32)
        for j in range(int(length.max(initial=0)).bit_length()):
            register = np.where(length >> j & 1, self.advance(register, j), register)
        return register ^ np.uint32(0xFFFFFFFF)

    def _contributions(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """XOR of the contributions of every span of 1 to ``span`` bytes, GATHER bytes at a time."""
        out = np.empty(len(start), np.uint32)
        size = end - start
        done = np.cumsum(size)
        at = 0
        while at < len(start):
            to = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + GATHER, side="right")))
            n, last = size[at:to], end[at:to]
            first = np.cumsum(n) - n
            position = np.arange(first[-1] + n[-1]) + np.repeat(start[at:to] - first, n)
            distance = np.repeat(last - 1, n) - position
            out[at:to] = np.bitwise_xor.reduceat(self.table.ravel()[distance << 8 | data[position]], first)
            at = to
        return out

    def crc32(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Unsigned crc32 of data[start:end] per span; no span is empty."""
        size = end - start
        if not len(size):
            return np.zeros(0, np.uint32)
        short = size <= self.span
        raw, added = np.empty(len(size), np.uint32), np.empty(len(size), np.uint32)
        raw[short] = self._contributions(data, start[short], end[short])
        added[short] = self.constants[size[short]]
        if not short.all():
            raw[~short] = self._folded(data, start[~short], end[~short])
            lengths, which = np.unique(size[~short], return_inverse=True)
            added[~short] = self.constant(lengths)[which]
        return raw ^ added

    def _folded(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Long spans: blocks from the end, folded in pairs, all spans at once. A missing left block
        is zero, which contributes nothing."""
        blocks = -(-(end - start) // self.span)
        first = np.cumsum(blocks) - blocks
        owner = np.repeat(np.arange(len(blocks)), blocks)
        back = first[owner] + blocks[owner] - 1 - np.arange(len(owner))      # blocks behind this one
        stop = end[owner] - back * self.span
        value = self._contributions(data, np.maximum(start[owner], stop - self.span), stop)
        j = self.span.bit_length() - 1
        while blocks.max() > 1:
            halves = -(-blocks // 2)
            place = np.cumsum(halves) - halves
            left, right = np.zeros(halves.sum(), np.uint32), np.zeros(halves.sum(), np.uint32)
            pair = place[owner] + halves[owner] - 1 - back // 2
            even = back % 2 == 0
            right[pair[even]] = value[even]
            left[pair[~even]] = value[~even]
            value = self.advance(left, j) ^ right
            blocks, j = halves, j + 1
            owner = np.repeat(np.arange(len(blocks)), blocks)
            back = place[owner] + blocks[owner] - 1 - np.arange(len(owner))
        return value


_TABLES: dict[int, PositionTable] = {}


def position_table(span: int = SPAN) -> PositionTable:
    """One table per process."""
    if span not in _TABLES:
        _TABLES[span] = PositionTable(span)
    return _TABLES[span]


def features(texts: list[bytes], table: PositionTable, grams: int = GRAMS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """crc32 of every feature of every text (text by text), features per text, words per text."""
    data = np.frombuffer(b" ".join(texts).translate(FOLDED) + b" ", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])      # where the next text begins
    # every word behind one space only, so that n-grams are spans of the buffer
    solid = data != 0x20
    keep = solid | np.r_[False, solid[:-1]]
    after = np.cumsum(keep)
    data = data[keep]
    solid = data != 0x20
    start = np.flatnonzero(solid & np.r_[True, ~solid[:-1]][:len(solid)])
    stop = np.flatnonzero(solid & np.r_[~solid[1:], True][:len(solid)]) + 1
    owner = np.searchsorted(after[ends - 1] if len(ends) else ends, start, side="right")
    crcs, owners = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for n in range(1, grams + 1):
        inside = owner[:len(owner) - n + 1] == owner[n - 1:] if len(owner) >= n else np.zeros(0, bool)
        first = np.flatnonzero(inside)
        crcs.append(table.crc32(data, start[first], stop[first + n - 1]))
        owners.append(owner[first])
    whose = np.concatenate(owners)
    order = np.argsort(whose, kind="stable")
    return (np.concatenate(crcs)[order], np.bincount(whose, minlength=len(texts)),
            np.bincount(owner, minlength=len(texts)))


def _slices(texts: Iterator[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= SLICE_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def hashed(documents: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """``documents`` with their text replaced by n_words, n_features and buckets, the features' buckets
    as little-endian numbers of two bytes (four beyond 65536 buckets)."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = position_table()
        for batch in batches:
            at = batch.schema.get_field_index("text")
            words, counts, coded = [], [], []
            for part in _slices(t.as_py() or b"" for t in batch.column(at)):
                crc, n, w = features(part, table, grams)
                bucket = (crc % np.uint32(buckets)).astype(kind)
                coded += [piece.tobytes() for piece in np.split(bucket, np.cumsum(n)[:-1])]
                words.append(w)
                counts.append(n)
            keep = [c for c in batch.schema.names if c != "text"]
            none = np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in keep),
                 pa.array(np.concatenate([none, *words])), pa.array(np.concatenate([none, *counts])),
                 pa.array(coded, pa.binary())], [*keep, "n_words", "n_features", "buckets"])

    coded = documents.withColumn("text", F.col("text").cast("binary"))
    added = StructType.fromDDL("n_words bigint, n_features bigint, buckets binary")
    return coded.mapInArrow(run, StructType(coded.drop("text").schema.fields + added.fields))


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in ``rows`` (of ``hashed``): every task adds up its own."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for b in batch.column(0):
                total += np.bincount(np.frombuffer(b.as_py(), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    counts = rows.select("buckets").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in counts.collect():       # one row per bucket at most
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the log ratio of smoothed shares, per bucket."""
    size = len(source)
    s, t = float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(b) + 1) * (s + size) / ((float(a) + 1) * (t + size))))
                     for a, b in zip(source, target)], np.int64)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Floored thousandths of Gumbel noise from the hash of ``seed:doc_id``."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _weighted(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    kind = np.dtype("<u2" if len(gain) <= 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("buckets")
            sums = [int(gain[np.frombuffer(b.as_py(), kind)].sum()) for b in batch.column(at)]
            keep = [c for c in batch.schema.names if c != "buckets"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array(sums, pa.int64())], [*keep, "weight"])

    return rows.mapInArrow(run, rows.drop("buckets").schema.add("weight", "long"))


def resampled(documents: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
              seed: int = SEED, grams: int = GRAMS, buckets: int = BUCKETS, text_out: bool = True) -> DataFrame:
    """``documents`` (doc_id, text; without text if not ``text_out``) with n_features, weight, score and
    rank. Rank 1, 2, 3, ... are the ``percent`` per cent (rounded down) of the rows with ``min_words``
    words or more that are drawn by the distribution of ``target`` (text); all others have none."""
    return sheltered(documents, ("doc_id", "text"), lambda rows: _resampled(
        rows, target, percent, min_words, seed, grams, buckets, text_out))


def _resampled(documents: DataFrame, target: DataFrame, percent: int, min_words: int, seed: int, grams: int,
               buckets: int, text_out: bool) -> DataFrame:
    rows = documents.withColumn("_tie", F.xxhash64("text"))
    if text_out:
        rows = rows.withColumn("_text", F.col("text"))
    rows = staged(hashed(rows, grams, buckets), "buckets")
    gain = gains(bucket_counts(rows, buckets), bucket_counts(hashed(target.select("text"), grams, buckets), buckets))
    scored = _weighted(rows, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    able = scored.filter(F.col("n_words") >= min_words)
    ranked = numbered(able, F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_tie").asc(), name="_place")
    drawn = percent * rows.filter(F.col("n_words") >= min_words).count() // 100
    first = ranked.withColumn("rank", F.when(F.col("_place") < drawn, F.col("_place") + 1))
    rest = scored.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    out = first.drop("_place").unionByName(rest)
    kept = ["doc_id", *(["text"] if text_out else []), *(["rest"] if "rest" in documents.columns else [])]
    return out.withColumnRenamed("_text", "text").select(*kept, "n_features", "weight", "score", "rank")


def drawn(documents: DataFrame, target: DataFrame, **settings: int) -> DataFrame:
    """The drawn documents, all their columns and no others."""
    marked = documents.select(F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in documents.columns]).alias("row"),
                              "doc_id", "text")
    return resampled(marked, target, **settings).filter(F.col("rank").isNotNull()).select("row.*")


def digest(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The query."""
    return resampled(documents.select("doc_id", "text"), benchmark, text_out=False).select(
        "doc_id", "n_features", "weight", "score", "rank")
