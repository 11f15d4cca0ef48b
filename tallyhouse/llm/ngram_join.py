"""N-gram Jaccard join by parity sketches.

A document's set holds its distinct 5-word shingles; two documents link when
100 * |A & B| >= 80 * |A | B|. With d = |A ^ B| (symmetric difference) that is d <= (|A|+|B|)/9.

Sketches. Shingle hashes are dealt into blocks and XORed within each block, so a block's sketch
changes only if the symmetric difference touches it: the number of differing blocks (and the
Hamming distance of the parity bits kept beside them, 64 * PARITY in all) is a lower bound of d.

Pigeonhole join. Sizes fall into bands [2^k, 2^(k+1)); documents up to 1.25 times the upper end
take part in a band too, so every pair that can link meets in the band of its smaller set. A
band has m blocks; a linked pair agrees on m - d of them at least. Blocks are ordered by how
many shingles they hold (a property of the sketch, hence one order for all documents), and each
document is indexed under its first D + 1 blocks, D being the largest d its size allows: a linked
pair must share one of these (prefix filtering over blocks). So no linked pair is lost, and keys
made of several shingles each keep chance meetings rare.

Verification without all pairs. Copies (equal sets) collapse first. In each key's group the
member that shares most keys with others is the hub; hub and members are verified on their exact
sets, links make components, and only groups that still hold several components go on: after
ROUNDS hubs, every remaining cross-component pair of such a group that its parity sketches allow
is verified. A pair is skipped only if its documents are already connected.

Defined results: A-Z are lower-cased, words are runs without ASCII white space; fewer than five
words form one shingle; documents without words have an empty set and link with nothing;
repeated rows are equal sets; a null doc_id is larger than any other when the smallest is sought;
an empty table gives no rows. Other columns pass through, but for those named like an added
column, which it replaces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, release, sheltered, staged

WORDS = 5
LINK, WHOLE = 80, 100        # similarity LINK / WHOLE, the bounds below follow from 0.8
SLACK = 1.1                  # blocks per block a document can be indexed under
ROUNDS = 2                   # hubs tried per group before its remaining pairs are compared
SLICE_BYTES = 2 << 20
PARITY = 16                  # 64-bit words of parity bits per set
_MUL = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)   # odd multipliers


def _mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (two xor-shift multiplications)."""
    x = x + np.uint64(seed)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts one after another, and where each begins."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.string())))
    edge = split.offsets.to_numpy() - split.offsets[0].as_py()
    words = split.flatten().dictionary_encode()
    vocab = np.r_[words.dictionary.to_numpy(zero_copy_only=False), np.array([""], dtype=object)]
    hashed = pd.util.hash_array(vocab, categorize=False)
    at = words.indices.to_numpy(zero_copy_only=False)
    real = (vocab != "")[at].astype(bool)
    before = np.r_[0, np.cumsum(real)]
    edge = before[edge]
    w = hashed[at[real]]
    n = np.diff(edge)
    if len(w) >= WORDS:
        rolled = sum(w[i:len(w) - WORDS + 1 + i] * _MUL[i] for i in range(WORDS))
        rolled = _mix(rolled)
    else:
        rolled = np.zeros(0, np.uint64)
    sets, begin = [], [0]
    for i, k in enumerate(n):
        if k >= WORDS:
            part = np.sort(rolled[edge[i]:edge[i + 1] - WORDS + 1])
            if len(part) > 1:
                part = part[np.r_[True, part[1:] != part[:-1]]]
        elif k:
            part = _mix((w[edge[i]:edge[i + 1]] * _MUL[:k]).sum(keepdims=True), int(k))
        else:
            part = np.zeros(0, np.uint64)
        sets.append(part)
        begin.append(begin[-1] + len(part))
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.array(begin)


def bands(n: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bands of sets of size n as (taking part, band, keys needed): a set's own band, and the
    band below for sets up to 1.25 times its upper end."""
    own = np.floor(np.log2(np.maximum(n, 1))).astype(np.int64)
    low = 1 << own
    first = (n >= 4, own, n // 4 + 1)
    second = ((n >= 5) & (4 * n < 5 * low) & (own >= 3), own - 1, (low - 1 + n) // 9 + 1)
    return [first, second]


def band_blocks(band: np.ndarray) -> np.ndarray:
    """Blocks of a band: as many as its largest prefix, and some slack."""
    return np.ceil(((1 << (band + 1)) // 4 + 1) * SLACK).astype(np.int64)


def block_keys(h: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of sets (as ``shingle_sets`` gives them): (set number, key) arrays."""
    n = np.diff(begin)
    owner = np.repeat(np.arange(len(n)), n)
    mixed = _mix(h, 0x51ED270B)
    owners, keys = [], []
    for part, band, need in bands(n):
        m = band_blocks(np.maximum(band, 0))
        use = part[owner]
        if not use.any():
            continue
        o, x, y = owner[use], h[use], mixed[use]
        j = ((x >> np.uint64(32)) * m[o].astype(np.uint64)) >> np.uint64(32)
        start = np.flatnonzero(np.r_[True, (o[1:] != o[:-1]) | (j[1:] != j[:-1])])
        sig = np.bitwise_xor.reduceat(y, start)
        held = np.diff(np.r_[start, len(o)])
        bo, bj = o[start], j[start]
        order = np.lexsort((sig, -held, bo))
        bo, bj, sig, held = bo[order], bj[order], sig[order], held[order]
        have = np.bincount(bo, minlength=len(n))
        rank = np.arange(len(bo)) - (np.cumsum(have) - have)[bo]
        keep = rank < need[bo]
        place = (band[bo].astype(np.uint64) << np.uint64(48)) + (held.astype(np.uint64) << np.uint64(32))
        owners.append(bo[keep])
        keys.append(_mix(sig ^ _mix(place + bj))[keep])
        for d in np.flatnonzero(part & (have < need)):      # too few filled blocks: empty ones
            used = set(bj[bo == d].tolist())
            free = [b for b in range(int(m[d])) if b not in used][:int(need[d] - have[d])]
            owners.append(np.full(len(free), d))
            keys.append(_mix(_mix((np.uint64(band[d]) << np.uint64(48)) + np.array(free, np.uint64))))
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(owners), np.concatenate(keys)


def parity(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """PARITY 64-bit words of parity bits per set: each shingle flips one bit."""
    out = np.zeros((len(begin) - 1, PARITY), np.uint64)
    bit = _mix(h, 77) % np.uint64(64 * PARITY)
    owner = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    np.bitwise_xor.at(out, (owner, (bit >> np.uint64(6)).astype(int)), np.uint64(1) << (bit & np.uint64(63)))
    return out


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SLICE_BYTES or i == len(texts) - 1:
            yield start, i + 1
            start, size = i + 1, 0


def _texts(batch: pa.RecordBatch, name: str) -> list[str]:
    return ["" if t is None else t for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


BITS = [f"_p{i}" for i in range(PARITY)]
SKETCH = ", ".join(f"{c} bigint" for c in ("_n", "_k1", "_k2", *BITS)) + ", _keys array<bigint>"


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row with its set's size, two 64-bit sums that name the set, parity words and index
    keys. A task gives the keys of equal sets once: copies in one split need no more."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        texts = _texts(batch, "text")
        done = 0
        for i, j in _slices(texts):
            h, begin = shingle_sets(texts[i:j])
            n = np.diff(begin)
            sums = [np.r_[0, np.cumsum(_mix(h, s), dtype=np.uint64)].astype(np.uint64) for s in (11, 23)]
            k1, k2 = ((c[begin[1:]] - c[begin[:-1]]).view(np.int64) for c in sums)
            p = parity(h, begin).view(np.int64)
            owner, keys = block_keys(h, begin)
            order = np.argsort(owner, kind="stable")
            keys = keys[order].view(np.int64)
            cut = np.searchsorted(owner[order], np.arange(len(n) + 1))
            lists = []
            for d in range(len(n)):
                name = (int(k1[d]), int(k2[d]))
                lists.append(np.zeros(0, np.int64) if name in seen else keys[cut[d]:cut[d + 1]])
                seen.add(name)
            part = batch.slice(done, j - i)
            done = j
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(n, pa.int64()), pa.array(k1), pa.array(k2),
                 *(pa.array(p[:, c]) for c in range(PARITY)), pa.array(lists, pa.list_(pa.int64()))],
                [*part.schema.names, *(x.split()[0] for x in SKETCH.split(", "))])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, those whose key another row has too."""
    held = None        # last row of the batch before: key, id, whether it was given already
    for batch in batches:
        key, rid = (batch.column(c).to_numpy() for c in (0, 1))
        if not len(key):
            continue
        if held is not None:
            key, rid = np.r_[held[0], key], np.r_[held[1], rid]
        same = key[1:] == key[:-1]
        keep = np.r_[False, same] | np.r_[same, False]
        if held is not None:
            keep[0] &= not held[2]
        held = (key[-1], rid[-1], bool(keep[-1]) or (len(key) == 1 and held is not None and held[2]))
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(rid[keep])], ["key", "rid"])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs with their texts: whether the exact sets link."""
    for batch in batches:
        left, right = _texts(batch, "ta"), _texts(batch, "tb")
        linked = np.zeros(len(left), bool)
        lengths = [a + b for a, b in zip(left, right)]
        for i, j in _slices(lengths):
            h, begin = shingle_sets(left[i:j] + right[i:j])
            for d in range(j - i):
                a = h[begin[d]:begin[d + 1]]
                b = h[begin[j - i + d]:begin[j - i + d + 1]]
                both = len(np.intersect1d(a, b, assume_unique=True))
                linked[i + d] = WHOLE * both >= LINK * (len(a) + len(b) - both) and both > 0
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked)], ["a", "b", "linked"])


def _plausible(a: str, b: str):
    """Bounds on the sizes and on the Hamming distance of the parity words of a pair."""
    c = lambda s, x: F.col(f"{s}.{x}")
    n, m = c(a, "_n"), c(b, "_n")
    apart = sum(F.bit_count(c(a, f"_p{i}").bitwiseXOR(c(b, f"_p{i}"))) for i in range(PARITY))
    return (WHOLE * n >= LINK * m) & (WHOLE * m >= LINK * n) & (9 * apart <= n + m)


def sketch_rows(documents: DataFrame) -> DataFrame:
    """``documents`` with a row id and sketches, written to the shared folder."""
    rows = documents.withColumn("_rid", F.monotonically_increasing_id())
    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL(SKETCH).fields])
    return staged(rows.mapInArrow(_sketches, schema), "sketches")


def links(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From sketched rows: (a, b) links between class representatives that connect every
    component, and membership (_rid, cid): the class a row's set belongs to."""
    sets = rows.filter("_n > 0")
    classes = sets.groupBy("_k1", "_k2", "_n").agg(F.min("_rid").alias("cid"))
    member = staged(sets.select("_rid", "_k1", "_k2", "_n").join(classes, ["_k1", "_k2", "_n"])
                    .select("_rid", "cid"), "member")
    info = ["_n", *BITS]
    scratch: list[DataFrame] = []

    def kept(df: DataFrame, name: str) -> DataFrame:
        scratch.append(staged(df, name))
        return scratch[-1]

    facts = kept(sets.select(F.col("_rid").alias("cid"), *info)
                   .join(member.select("cid").distinct(), "cid"), "facts")
    texts = rows.select(F.col("_rid").alias("cid"), "text")

    keyed = sets.select(F.explode("_keys").alias("key"), F.col("_rid").alias("rid"))
    met = kept(keyed.repartition("key").sortWithinPartitions("key", "rid")
                 .mapInArrow(_shared, "key bigint, rid bigint"), "met")
    group = kept(met.join(member.withColumnRenamed("_rid", "rid"), "rid").select("key", "cid").distinct(), "group")
    sizes = group.groupBy("key").agg((F.count("*") - 1).alias("others")).filter("others > 0")
    group = kept(group.join(sizes, "key"), "groups")
    weight = kept(group.groupBy("cid").agg(F.sum("others").alias("weight")), "weight")
    active = group.select("key", "cid").join(weight, "cid")
    tested: DataFrame | None = None
    label = None
    for turn in range(ROUNDS + 1):
        now = active if label is None else active.drop("comp").join(label, "cid", "left")
        now = now.withColumn("comp", F.coalesce("comp", "cid") if label is not None else F.col("cid"))
        spread = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                        F.max(F.struct("weight", (-F.col("cid")).alias("c"))).alias("top"))
        mixed = spread.filter("lo < hi").select("key", (-F.col("top.c")).alias("hub"))
        active = kept(now.join(mixed, "key"), "active")
        if turn < ROUNDS:
            pairs = (active.filter("cid <> hub").select(F.least("hub", "cid").alias("a"), F.greatest("hub", "cid").alias("b"))
                     .distinct())
        else:
            pairs = _crossing(kept(active.select("key", "cid", "comp").join(facts, "cid"), "crossing"))
        pairs = (pairs.alias("p").join(facts.alias("x"), F.col("p.a") == F.col("x.cid"))
                 .join(facts.alias("y"), F.col("p.b") == F.col("y.cid"))
                 .filter(_plausible("x", "y")).select("a", "b"))
        if tested is not None:
            pairs = pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")
        pairs = kept(pairs, "pairs")
        checked = kept(
            pairs.join(texts.select(F.col("cid").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("cid").alias("b"), F.col("text").alias("tb")), "b")
            .select("a", "b", "ta", "tb").mapInArrow(_verified, "a bigint, b bigint, linked boolean"), "checked")
        tested = checked if tested is None else kept(tested.union(checked), "tested")
        if turn < ROUNDS:
            label = kept(components(tested.filter("linked").select("a", "b"))
                           .select(F.col("id").alias("cid"), F.col("component").alias("comp")), "label")
            # the hub's pairs in this group are settled
            active = active.filter("cid <> hub").select("key", "cid", "weight", "comp")
    edges = staged(tested.filter("linked").select("a", "b"), "edges")
    release(*scratch)
    return edges, member


def _crossing(full: DataFrame) -> DataFrame:
    """Every pair of a group whose members lie in different components and whose sizes and
    parity words allow a link, once each."""
    x, y = full.alias("x"), full.alias("y")
    apart = (F.col("x.key") == F.col("y.key")) & (F.col("x.cid") < F.col("y.cid")) & (F.col("x.comp") != F.col("y.comp"))
    return (x.join(y, apart & _plausible("x", "y"))
            .select(F.col("x.cid").alias("a"), F.col("y.cid").alias("b")).distinct())


def linked_rows(documents: DataFrame) -> DataFrame:
    """``documents`` with n_shingles, component_id (the smallest doc_id reachable by links) and
    _first: whether the row is the first of its component (by doc_id, then row id)."""
    return sheltered(documents, ("doc_id", "text"), _linked_rows)


def _linked_rows(documents: DataFrame) -> DataFrame:
    rows = sketch_rows(documents)
    edges, member = links(rows)
    labels = components(edges).select(F.col("id").alias("cid"), F.col("component").alias("_comp"))
    whole = member.join(labels, "cid", "left").select("_rid", F.coalesce("_comp", "cid").alias("_comp"))
    back = staged(rows.select("_rid", "doc_id").join(whole, "_rid", "left")
                  .select("_rid", "doc_id", F.coalesce("_comp", "_rid").alias("_comp")), "labelled")
    least = back.groupBy("_comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"),
                                                     F.col("_rid").alias("r"))).alias("best"))
    named = staged(back.join(least, "_comp").select("_rid", F.col("best.d").alias("component_id"),
                                                    (F.col("best.r") == F.col("_rid")).alias("_first")), "named")
    release(edges, member, back)
    return rows.join(named, "_rid").select(
        *documents.columns, F.col("_n").alias("n_shingles"), "component_id", "_first")


def digest(documents: DataFrame) -> DataFrame:
    """The query: doc_id, n_shingles, component_id."""
    return linked_rows(documents.select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")
