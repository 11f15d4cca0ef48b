"""Language identification by a bidirectional gated recurrent network over bytes.

Two GRUs read the UTF-8 bytes of a text forwards and backwards; a softmax on both states labels
every byte position, and a document's probabilities are the mean over all its positions. The
network is written and trained in numpy by backpropagation through time; no other features
enter a prediction.

A text is read whole, as consecutive windows of WINDOW bytes that start from a zero state, so
the work is one pass over the bytes in large batches and memory does not depend on the length
of a text.

Training uses a bounded sample: per language LABELLED documents of the training rows, drawn by
hashes of doc_id and text, WINDOWS windows of each. Windows, initial weights and batches
come from fixed seeds, so reruns agree.

Defined results: text that is null or has no letter gets ``und`` with score 0; without any
training row every text does. Null languages are not learned. Repeated rows and null doc_ids are
scored like any others; an empty table gives no rows. Other columns pass through, but for those
named like an added column, which it replaces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import sheltered, staged

HIDDEN = 12            # units per direction
WINDOW = 128           # bytes read from one zero state when predicting
TRAIN_WINDOW = 48      # bytes per training window
LABELLED = 300         # training documents per language at most
WINDOWS = 16           # training windows per document
STEPS = 800            # gradient steps ...
BATCH = 256            # ... of so many windows
LANES = 2048           # windows predicted at once
RATE = 0.02
UNKNOWN = "und"
ADDED = ("lang_pred", "score")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class ByteGRU:
    """Weights and both passes of the network. Shapes: ``x[d]`` (3H, 256) input columns with
    biases, ``u[d]`` (3H, H) recurrent weights, ``o[d]`` (K, H) read-outs, ``b`` (K,)."""

    def __init__(self, classes: list[str], hidden: int = HIDDEN, seed: int = 1):
        r = np.random.default_rng(seed)
        k, h = len(classes), hidden
        self.classes, self.h = classes, h
        self.p = {f"x{d}": r.normal(0, 0.3, (3 * h, 256)) for d in "fb"}
        self.p |= {f"u{d}": r.normal(0, 0.35, (3 * h, h)) for d in "fb"}
        self.p |= {f"o{d}": r.normal(0, 0.3, (k, h)) for d in "fb"} | {"b": np.zeros((k, 1))}
        for d in "fb":
            self.p[f"x{d}"][:h] += 1.0      # gates start by remembering

    # ---- training ----
    def _run(self, data: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """States (T, H, B) of one direction in reading order, and what the way back needs."""
        h, x, u = self.h, self.p["x" + d], self.p["u" + d]
        state, states, tape = np.zeros((h, data.shape[1])), [], []
        for row in data:
            a, g = x[:, row], u @ state
            z = _sigmoid(a[:h] + g[:h])
            r = _sigmoid(a[h:2 * h] + g[h:2 * h])
            n = np.tanh(a[2 * h:] + r * g[2 * h:])
            tape.append((row, state, z, r, n, g[2 * h:]))
            state = n + z * (state - n)
            states.append(state)
        return np.stack(states), tape

    def _back(self, grads: np.ndarray, tape: list, d: str, out: dict) -> None:
        h, u = self.h, self.p["u" + d]
        gx, gu = np.zeros_like(self.p["x" + d]), np.zeros_like(u)
        carry = np.zeros_like(grads[0])
        for t in range(len(tape) - 1, -1, -1):
            row, prev, z, r, n, gn = tape[t]
            dh = grads[t] + carry
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (prev - n) * z * (1 - z)
            dr = dn * gn * r * (1 - r)
            rec = np.concatenate([dz, dr, dn * r])
            inp = np.concatenate([dz, dr, dn])
            gu += rec @ prev.T
            np.add.at(gx.T, row, inp.T)
            carry = dh * z + u.T @ rec
        out["x" + d], out["u" + d] = gx, gu

    def gradients(self, data: np.ndarray, want: np.ndarray) -> tuple[float, dict]:
        """Mean cross-entropy of all positions of ``data`` (T, B bytes) and its gradients."""
        f, tf = self._run(data, "f")
        b, tb = self._run(data[::-1], "b")
        back = b[::-1]
        logits = self.p["of"] @ f + self.p["ob"] @ back + self.p["b"]
        logits -= logits.max(axis=1, keepdims=True)
        prob = np.exp(logits)
        prob /= prob.sum(axis=1, keepdims=True)
        lanes = np.arange(data.shape[1])
        loss = -np.log(prob[:, want, lanes] + 1e-12).mean()
        err = prob
        err[:, want, lanes] -= 1
        err /= data.size
        out = {"of": np.einsum("tkb,thb->kh", err, f), "ob": np.einsum("tkb,thb->kh", err, back),
               "b": err.sum(axis=(0, 2))[:, None]}
        self._back(self.p["of"].T @ err, tf, "f", out)
        self._back((self.p["ob"].T @ err)[::-1], tb, "b", out)
        return loss, out

    def train(self, windows: np.ndarray, want: np.ndarray, steps: int = STEPS, seed: int = 2) -> list[float]:
        """Adam over shuffled batches of ``windows`` (N, T); returns the losses."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        losses = []
        for step in range(1, steps + 1):
            at = r.integers(0, len(windows), BATCH)
            loss, grads = self.gradients(np.ascontiguousarray(windows[at].T), want[at])
            losses.append(loss)
            norm = np.sqrt(sum((g * g).sum() for g in grads.values()))
            rate = RATE * min(1.0, 1.0 / (norm + 1e-9)) * (0.5 + 0.5 * np.cos(np.pi * step / steps))
            rate = max(rate, 1e-4)
            for k, g in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                self.p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
        return losses

    # ---- prediction ----
    def ready(self) -> dict:
        """Weights for prediction: single precision, gate rows halved (sigmoid by tanh)."""
        half = np.ones((3 * self.h, 1))
        half[:2 * self.h] = 0.5
        out = {k: (v * half if k[0] in "xu" else v).astype(np.float32) for k, v in self.p.items()}
        return out | {"h": self.h}


def _read(w: dict, data: np.ndarray, d: str, out: np.ndarray, length: np.ndarray | None) -> None:
    """Adds one direction's read-out at every position to ``out`` (T, K, B); backwards when
    ``length`` gives the lanes' lengths: a lane's state stays zero until its last byte."""
    h, x, u, o = w["h"], w["x" + d], w["u" + d], w["o" + d]
    steps, lanes = data.shape
    state = np.zeros((h, lanes), np.float32)
    a = np.empty((3 * h, lanes), np.float32)
    g, part, read = np.empty_like(a), np.empty_like(state), np.empty(out.shape[1:], np.float32)
    gates, new = a[:2 * h], a[2 * h:]
    shortest = steps if length is None else int(length.min())
    for t in range(steps) if length is None else range(steps - 1, -1, -1):
        np.take(x, data[t], axis=1, out=a, mode="clip")
        np.matmul(u, state, out=g)
        gates += g[:2 * h]
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        np.multiply(a[h:2 * h], g[2 * h:], out=part)
        new += part
        np.tanh(new, out=new)
        state -= new
        state *= a[:h]
        state += new
        if length is not None and t >= shortest:
            state *= t < length
        np.matmul(o, state, out=read)
        out[t] += read


def position_probabilities(w: dict, data: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Probabilities (T, K, B) for every position of windows (T, B bytes) of given lengths."""
    out = np.empty((len(data), len(w["b"]), data.shape[1]), np.float32)
    out[:] = w["b"]
    _read(w, data, "f", out, None)
    _read(w, data, "b", out, length)
    np.exp(out, out=out)
    out /= out.sum(axis=1, keepdims=True)
    return out


def document_probabilities(w: dict, texts: list[bytes], window: int = WINDOW) -> np.ndarray:
    """Mean probabilities (documents, K) over all byte positions of each text; zeros for empty.

    Windows of like length are read side by side; positions past a window's end are masked out
    of the mean.
    """
    k = len(w["b"])
    sums = np.zeros((len(texts), k))
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    count = -(-size // window)
    owner = np.repeat(np.arange(len(texts)), count)
    flat = np.frombuffer(b"".join(texts), np.uint8)
    first = np.cumsum(size) - size
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    begin = first[owner] + nth * window
    length = np.minimum(window, size[owner] - nth * window)
    order = np.argsort(length, kind="stable")       # lanes of like length share a batch
    for i in range(0, len(order), LANES):
        at = order[i:i + LANES]
        n = length[at]
        steps = int(n.max())
        where = np.minimum(begin[at][None, :] + np.arange(steps)[:, None], max(len(flat) - 1, 0))
        prob = position_probabilities(w, flat[where], n)
        if n.min() < steps:
            prob *= (np.arange(steps)[:, None] < n)[:, None, :]
        np.add.at(sums, owner[at], prob.sum(axis=0).T)
    return sums / np.maximum(size, 1)[:, None]


def training_rows(documents: DataFrame) -> Column:
    """Rows to learn from: crc32 of the doc_id's digits mod 4 is not 2, and lang is known."""
    return ~held_out(F.col("doc_id")) & F.col("lang").isNotNull()


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def text_windows(raw: bytes, window: int = TRAIN_WINDOW) -> np.ndarray:
    """WINDOWS evenly spread windows of a text, one a row (short texts repeat, empty ones have none)."""
    data = np.frombuffer(raw, np.uint8)
    if len(data) < window:
        data = np.resize(data, window) if len(data) else np.zeros(0, np.uint8)
    starts = np.linspace(0, len(data) - window, WINDOWS).astype(int) if len(data) else []
    return np.array([data[s:s + window] for s in starts], np.uint8).reshape(-1, window)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, n, text) to (lang, n, windows): whole texts stay in the tasks."""
    for batch in batches:
        cut = [text_windows(t.as_py()).tobytes() for t in batch.column(2).cast(pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cut, pa.binary())], ["lang", "n", "windows"])


def train(documents: DataFrame) -> ByteGRU | None:
    """A network trained on the training rows of ``documents`` (doc_id, text, lang)."""
    mark = F.xxhash64("text")
    spread = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "_mark", "doc_id")
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    usable = documents.filter(training_rows(documents) & letters).select("doc_id", "text", "lang")
    # chosen on narrow rows; LABELLED per language
    narrow = staged(usable.select("lang", "doc_id", mark.alias("_mark")).distinct(), "usable")
    # first about 3 * LABELLED per language by hash, where the rows are: the counts (one row per
    # language) come to them, and only those rows cross the network by language
    many = narrow.groupBy("lang").agg(F.count("*").alias("_n"))
    draw = F.pmod(F.xxhash64(F.lit(99), "doc_id", "_mark"), F.lit(1 << 40)) / float(1 << 40)
    near = narrow.join(F.broadcast(many), "lang").filter(draw * F.col("_n") < 3 * LABELLED).drop("_n")
    chosen = (near
              .withColumn("n", F.row_number().over(spread)).filter(F.col("n") <= LABELLED))
    found = usable.withColumn("_mark", mark).join(F.broadcast(chosen), ["lang", "doc_id", "_mark"])
    rows = (found.dropDuplicates(["lang", "doc_id", "_mark"]).select("lang", "n", "text")
            .mapInArrow(_cut, "lang string, n int, windows binary").collect())
    rows.sort(key=lambda r: (r.lang, r.n))
    classes = sorted({r.lang for r in rows})
    if not classes:
        return None
    net = ByteGRU(classes)
    if len(classes) > 1:
        data = np.frombuffer(b"".join(r.windows for r in rows), np.uint8).reshape(-1, TRAIN_WINDOW)
        net.train(data, np.repeat([classes.index(r.lang) for r in rows], [len(r.windows) // TRAIN_WINDOW for r in rows]))
    return net


def identify(documents: DataFrame, net: ByteGRU | None, text_out: bool = True) -> DataFrame:
    """``documents`` (without text if not ``text_out``) with lang_pred and score; only the text
    is read."""
    return sheltered(documents, ("doc_id", "text"), lambda rows: _identify(rows, net, text_out))


def _identify(documents: DataFrame, net: ByteGRU | None, text_out: bool) -> DataFrame:
    kept = documents if text_out else documents.drop("text")
    if net is None:
        return kept.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast((net.ready(), net.classes))   # a few kB
    marked = documents.withColumn("_letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, classes = shared.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
            letters = batch.column(batch.schema.get_field_index("_letters")).to_pylist()
            prob = document_probabilities(weights, [t if ok else b"" for t, ok in zip(texts, letters)])
            best = prob.argmax(axis=1) if len(prob) else np.zeros(0, int)
            names = [classes[i] if ok else UNKNOWN for i, ok in zip(best, letters)]
            score = np.where(letters, prob.max(axis=1, initial=0), 0.0).clip(0, 1)
            keep = [c for c in batch.schema.names if c != "_letters" and (text_out or c != "text")]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in keep]
                                             + [pa.array(names, pa.string()), pa.array(score, pa.float64())],
                                             keep + list(ADDED))

    schema = kept.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return marked.mapInArrow(label, schema)


def digest(documents: DataFrame) -> DataFrame:
    """The query: doc_id, held_out, lang_pred, score."""
    net = train(documents)
    return identify(documents.select("doc_id", "text"), net, text_out=False).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
