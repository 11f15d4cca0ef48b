"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: densities of lexicon words (a fixed list, and words and word beginnings
mined from training labels), the largest density in any WINDOW words, how near they stand to second-person words,
capitals, punctuation and obfuscation (digits or signs inside words, lexicon words that appear
only when those are undone). The trees are histogram-based and fitted in numpy to the logistic
loss; isotonic regression on labelled rows of their own maps margins to probabilities.

Learning uses a bounded sample: about LABELLED labelled training rows chosen by a hash of
doc_id, split by hash into parts for mining the lexicon, growing the trees and calibrating.
Fixed seeds and hash order make reruns agree.

Defined results: null or empty texts are scored from all-zero features; without labels of both
kinds every score is 0; a document labelled several times learns from its largest label; null
labels are ignored; repeated rows are scored alike; an empty table gives no rows. Other columns
pass through, but for those named like an added column, which it replaces.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import share, sheltered, staged

LABELLED = 16_000       # labelled rows learned from, about so many at most (by hash of doc_id)
MINED = 300             # words and stems mined from labels at most
STEMS = (4, 5)          # lengths of word beginnings mined as well (written with a star)
SUPPORT = 6             # toxic documents that a mined word or stem must stand in
THRESHOLD = 0.3
WINDOW = 50             # words in which the densest passage is sought
NEAR = 4                # words between a lexicon word and a second-person word
TREES, DEPTH, RATE, BINS = 80, 3, 0.15, 32
SLICE_BYTES = 2 << 20
ADDED = ("score", "predicted")

INSULTS = tuple("""idiot idiots moron morons stupid dumb fool loser losers scum trash garbage pathetic
worthless disgusting clown clowns imbecile cretin pig swine vermin filth retard dimwit halfwit jerk
creep coward liar ugly useless dummkopf trottel abschaum wertlos ekelhaft dreck connard
imbécile débile ordure minable pathétique imbécil estúpido estúpida basura escoria patético asqueroso
inútil""".split())
HOSTILE = tuple("""hate kill die shut destroy hang burn rape murder hurt beat stab damn hell shit fuck
fucking bitch bastard ass asshole crap hasse töten stirb scheisse scheiße arschloch déteste tuer crève
merde salope odio matar muere mierda puta cabrón""".split())
SECOND = tuple("""you your yours yourself yourselves u ur du dich dir dein deine euch ihr tu te toi ton
ta tes vous votre vos ti tú tus usted ustedes vosotros""".split())
LEET = str.maketrans("013457@$!|€", "oieastasiie")
EDGES = ".,;:!?\"'()[]{}<>*%&$#|-_~`«»“”„…¡¿"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


class Lexicon:
    """Word classes as bit flags, for the distinct words of a batch."""

    INSULT, HOSTILE, MINED, SECOND, HIDDEN = 1, 2, 4, 8, 16

    def __init__(self, mined: list[str]):
        self.flags: dict[str, int] = {}
        for bit, words in ((1, INSULTS), (2, HOSTILE), (4, mined), (8, SECOND)):
            for w in words:
                self.flags[w] = self.flags.get(w, 0) | bit
        self.keys = pa.array(list(self.flags), pa.string())
        self.values = np.array([*self.flags.values(), 0], np.uint8)

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flags of each distinct word, and whether signs or digits stand inside it."""
        core = pc.utf8_trim(pc.utf8_lower(words), EDGES)
        at = pc.fill_null(pc.index_in(core, self.keys), len(self.flags)).to_numpy(zero_copy_only=False)
        out = self.values[at].copy()
        for n in STEMS:
            stem = pc.binary_join_element_wise(pc.utf8_slice_codeunits(core, 0, n), "*", "")
            at = pc.fill_null(pc.index_in(stem, self.keys), len(self.flags)).to_numpy(zero_copy_only=False)
            out |= np.where(pc.utf8_length(core).to_numpy(zero_copy_only=False) >= n, self.values[at], 0).astype(np.uint8)
        odd = pc.match_substring_regex(core, r"\p{L}[^\p{L}\p{M}'’\-]+\p{L}|^[0-9@$!|]+\p{L}{2}").to_numpy(
            zero_copy_only=False)
        for i in np.flatnonzero(odd):
            word = core[i].as_py()
            bare = "".join(c for c in word.translate(LEET) if c.isalpha())
            out[i] |= (self.flags.get(bare, 0) & 7) and (self.flags[bare] & 7) | self.HIDDEN
        return out, odd


FEATURES = ("insults", "hostile", "mined", "hidden", "hits", "densest", "near_second", "second",
            "odd_words", "upper_words", "capitals", "exclaim", "question", "marks", "log_words",
            "word_length", "digits", "distinct_hits")


def features(texts: list[str], lexicon: Lexicon) -> np.ndarray:
    """One row of FEATURES per text."""
    out = np.zeros((len(texts), len(FEATURES)))
    arr = pa.array(texts, pa.string())
    split = pc.ascii_split_whitespace(arr)
    edge = split.offsets.to_numpy() - split.offsets[0].as_py()
    words = split.flatten().dictionary_encode()
    if not len(words):
        return out
    vocab, at = words.dictionary, words.indices.to_numpy(zero_copy_only=False)
    flags, odd = lexicon.of(vocab)
    upper = (pc.count_substring_regex(vocab, r"\p{Lu}").to_numpy(zero_copy_only=False)
             >= np.maximum(2, pc.count_substring_regex(vocab, r"\p{L}").to_numpy(zero_copy_only=False)))
    real = pc.utf8_length(vocab).to_numpy(zero_copy_only=False) > 0

    def total(per_word: np.ndarray) -> np.ndarray:
        run = np.r_[0, np.cumsum(per_word[at].astype(np.int64))]
        return (run[edge[1:]] - run[edge[:-1]]).astype(float)

    n = np.maximum(total(real), 1)
    hit = flags & 7 != 0
    chars = np.maximum(pc.utf8_length(arr).to_numpy(zero_copy_only=False), 1).astype(float)
    marks = {c: pc.count_substring(arr, c).to_numpy(zero_copy_only=False) for c in "!?"}
    letters = np.maximum(pc.count_substring_regex(arr, r"\p{L}").to_numpy(zero_copy_only=False), 1)
    out[:, 0] = total(flags & 1 != 0) / n
    out[:, 1] = total(flags & 2 != 0) / n
    out[:, 2] = total(flags & 4 != 0) / n
    out[:, 3] = total(flags & 16 != 0) / n
    hits = total(hit)
    out[:, 4] = np.log1p(hits)
    out[:, 7] = total(flags & 8 != 0) / n
    out[:, 8] = total(odd) / n
    out[:, 9] = total(upper) / n
    out[:, 10] = pc.count_substring_regex(arr, r"\p{Lu}").to_numpy(zero_copy_only=False) / letters
    out[:, 11], out[:, 12] = marks["!"] / n, marks["?"] / n
    out[:, 13] = pc.count_substring_regex(arr, r"[^\p{L}\p{M}\p{N}\s]").to_numpy(zero_copy_only=False) / chars
    out[:, 14] = np.log1p(n)
    out[:, 15] = np.minimum(letters / n, 40)
    out[:, 16] = pc.count_substring_regex(arr, r"[0-9]").to_numpy(zero_copy_only=False) / chars
    # passages: positions of hits and of second-person words, document by document
    where = np.flatnonzero(hit[at])
    you = np.flatnonzero(flags[at] & 8 != 0)
    first = np.searchsorted(where, edge)
    for d in np.flatnonzero(hits > 0):
        p = where[first[d]:first[d + 1]]
        ahead = np.searchsorted(p, p + WINDOW) - np.arange(len(p))
        out[d, 5] = ahead.max() / min(WINDOW, n[d])
        y = you[np.searchsorted(you, edge[d]):np.searchsorted(you, edge[d + 1])]
        if len(y):
            k = np.searchsorted(y, p)
            gap = np.minimum(np.abs(p - y[np.minimum(k, len(y) - 1)]), np.abs(p - y[np.maximum(k - 1, 0)]))
            out[d, 6] = (gap <= NEAR).mean()
        out[d, 17] = len(np.unique(at[p]))
    return out


class Trees:
    """Gradient-boosted regression trees on binned features, logistic loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        grid = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        for j, c in enumerate(x.T):      # features that are mostly zero: bins among the rest
            if len(grid[j]) < BINS // 2 and (c > 0).any():
                grid[j] = np.unique(np.r_[0.0, grid[j], np.quantile(c[c > 0], np.linspace(0, 0.95, BINS // 2))])
        self.edges = grid
        b = self._bins(x)
        rate = y.mean().clip(1e-4, 1 - 1e-4)
        self.base = float(np.log(rate / (1 - rate)))
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        margin = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grow(b, y - p, p * (1 - p))
            self.trees.append(tree)
            margin += self._leaf(b, tree)

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)], axis=1)

    def _grow(self, b: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple:
        inner, leaves = (1 << DEPTH) - 1, 1 << DEPTH
        feature, cut = np.zeros(inner, int), np.full(inner, 1 << 20)
        node = np.zeros(len(g), int)
        width = max(len(e) for e in self.edges) + 1
        for depth in range(DEPTH):
            lo, many = (1 << depth) - 1, 1 << depth
            best = np.full(many, 1e-6)
            for j in range(b.shape[1]):
                cell = (node - lo) * width + b[:, j]
                sg = np.bincount(cell, g, many * width).reshape(many, width)
                sh = np.bincount(cell, h, many * width).reshape(many, width)
                lg, lh = sg.cumsum(1)[:, :-1], sh.cumsum(1)[:, :-1]
                tg, th = sg.sum(1)[:, None], sh.sum(1)[:, None]
                gain = lg ** 2 / (lh + 1) + (tg - lg) ** 2 / (th - lh + 1) - tg ** 2 / (th + 1)
                gain[(lh < 1) | (th - lh < 1)] = 0
                at = gain.argmax(axis=1)
                value = gain[np.arange(many), at]
                better = value > best
                best = np.where(better, value, best)
                feature[lo:lo + many][better], cut[lo:lo + many][better] = j, at[better]
            node = 2 * node + 1 + (b[np.arange(len(b)), feature[node]] > cut[node])
        leaf = node - inner
        value = RATE * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + 1)
        return feature, cut, value

    def _leaf(self, b: np.ndarray, tree: tuple) -> np.ndarray:
        feature, cut, value = tree
        node = np.zeros(len(b), int)
        rows = np.arange(len(b))
        for _ in range(DEPTH):
            node = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
        return value[node - len(feature)]

    def margins(self, x: np.ndarray) -> np.ndarray:
        b = self._bins(x)
        return self.base + sum(self._leaf(b, t) for t in self.trees)


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (margin, probability) of a non-decreasing fit."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []      # sum, weight, lowest and highest margin
    for m, t in zip(margin[order], y[order]):
        blocks.append([float(t), 1.0, m, m])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, w, _, hi = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + w, blocks[-1][2], hi]
    knots = [(m, s / w) for s, w, lo, hi in blocks for m in ((lo, hi) if hi > lo else (lo,))]
    return np.array([k[0] for k in knots]), np.array([k[1] for k in knots])


class Model:
    def __init__(self, lexicon: Lexicon, trees: Trees, knots: tuple[np.ndarray, np.ndarray]):
        self.lexicon, self.trees, self.knots = lexicon, trees, knots

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability; a thousandth of it follows the margin, so that documents on
        one step of the isotonic fit keep their order."""
        m = self.trees.margins(x)
        fit = np.interp(m, *self.knots)
        return (0.999 * fit + 0.001 / (1 + np.exp(-m))).clip(0, 1)


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SLICE_BYTES or i == len(texts) - 1:
            yield start, i + 1
            start, size = i + 1, 0


def _featured(batch: pa.RecordBatch, lexicon: Lexicon) -> np.ndarray:
    texts = ["" if t is None else t for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
    return np.concatenate([features(texts[i:j], lexicon) for i, j in _slices(texts)] or
                          [np.zeros((0, len(FEATURES)))])


def _reaches(n: int, word: Column) -> Column:
    return F.length(word) >= n


def _stem(n: int, word: Column) -> Column:
    return F.concat(F.substring(word, 1, n), F.lit("*"))


def learn(documents: DataFrame, labels: DataFrame) -> Model | None:
    """A model from the training rows of ``documents`` (doc_id, text) with ``labels`` (doc_id,
    toxic)."""
    known = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("_y")))
    known = staged(known.join(documents.select("doc_id").distinct(), "doc_id", "left_semi"), "known")
    chosen = (known.filter(share(LABELLED, known.count(), "doc_id")).withColumn("_h", F.xxhash64("doc_id"))
              .withColumn("_part", F.pmod(F.xxhash64("_h"), F.lit(5))))
    # about LABELLED rows
    # (of a repeated doc_id the text with the smallest hash, so that reruns learn from the same rows)
    found = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = staged(found.groupBy("doc_id").agg(F.min_by(
        F.struct("text", "_y", "_part"), F.struct(F.xxhash64("text"), F.col("text"))).alias("r")).select(
            "doc_id", "r.text", "r._y", "r._part"), "labelled")
    words = F.array_distinct(F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}']+"),
                                      lambda w: F.length(w) > 1))
    stems = [F.transform(F.filter(words, partial(_reaches, n)), partial(_stem, n)) for n in STEMS]
    mining = rows.filter("_part < 2")
    n = mining.agg(F.sum("_y"), F.count("*")).first()
    bad, good = int(n[0] or 0), int(n[1] or 0) - int(n[0] or 0)
    mined: list[str] = []
    if bad and good:
        seen = mining.select("_y", F.explode_outer(F.array_distinct(F.concat(words, *stems))).alias("w")).groupBy("w").agg(
            F.sum("_y").alias("b"), F.count("*").alias("n")).filter(F.col("w").isNotNull() & (F.col("b") >= SUPPORT))
        odds = F.log((F.col("b") + 0.5) / (bad + 1)) - F.log((F.col("n") - F.col("b") + 0.5) / (good + 1))
        mined = [r.w for r in seen.withColumn("o", odds).filter(
            F.col("o") > F.when(F.col("w").endswith("*"), 4).otherwise(3)).orderBy(F.desc("o"), "w")
                 .limit(MINED).collect()]
    lexicon = Lexicon(mined)

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _featured(batch, lexicon)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "_y": batch.column(2), "_part": batch.column(3),
                "x": pa.array(list(x), pa.list_(pa.float64()))})

    got = (rows.select("doc_id", "text", "_y", F.col("_part").cast("long"))
           .mapInArrow(dense, "doc_id bigint, _y int, _part bigint, x array<double>")
           .filter("_part >= 2").collect())
    got.sort(key=lambda r: r.doc_id)
    if len({r._y for r in got if r._part < 4}) < 2 or not any(r._part == 4 for r in got):
        return None
    x = np.array([r.x for r in got])
    y, part = np.array([r._y for r in got], float), np.array([r._part for r in got])
    trees = Trees(x[part < 4], y[part < 4])
    return Model(lexicon, trees, isotonic(trees.margins(x[part == 4]), y[part == 4]))


def score(documents: DataFrame, model: Model | None, text_out: bool = True) -> DataFrame:
    """``documents`` (without text if not ``text_out``) with score and predicted; only the text
    is read."""
    return sheltered(documents, ("doc_id", "text"), lambda rows: _score(rows, model, text_out))


def _score(documents: DataFrame, model: Model | None, text_out: bool) -> DataFrame:
    kept = documents if text_out else documents.drop("text")
    if model is None:
        return kept.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)})

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.score(_featured(batch, model.lexicon))
            keep = [c for c in batch.schema.names if text_out or c != "text"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in keep]
                + [pa.array(s, pa.float64()), pa.array((s >= THRESHOLD).astype(np.int32))], keep + list(ADDED))

    return documents.mapInArrow(rate, kept.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema)


def digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The query: doc_id, held_out, score, predicted."""
    return score(documents.select("doc_id", "text"), learn(documents, labels), text_out=False).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
