"""Token-id files with a shared zstandard dictionary.

A store holds the token ids of documents in ascending doc_id order. Each document's ids are
serialised (little-endian, 2 bytes when every id fits, else 4) and compressed on their own with
one dictionary trained on a sample of serialised documents, so a short document can be read
without its neighbours and still compresses well.

Format, below one path of any file system Spark writes to:

* ``dictionary`` (Parquet, one row): ``dict_hash`` (sha256), ``dictionary`` (bytes), ``width``;
* ``frames`` (Parquet, uncompressed; one row per chunk): ``part``, ``chunk``, ``dict_hash``,
  ``payload`` (the chunk's zstandard frames one after another) and the offset index: arrays
  ``doc_id``, ``offset`` (one more than documents), ``n_tokens``; ``first_doc`` and ``last_doc`` are
  the least and greatest doc_id (null where all are), so that Parquet statistics rule chunks out.

Readers refuse a chunk whose dictionary hash is not that of the dictionary they hold.

Defined results: null text is empty and holds the end id only; an empty table makes a store
without chunks; null doc_ids come first and repeated doc_ids are stored in the order of their
texts' hash; only doc_id and text are read.

Tokenizing splits at ASCII white space and looks up each distinct word of a batch once: the
tokenizer drops white space and its patterns never cross it, so the ids of a text are those of
its words in order. It also lower-cases and cuts between letters and signs, so both are done
first unless a special token's string occurs; a word of ASCII letters goes to its model at once. ``whole_texts`` turns all that off for tokenizers
where it does not hold.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh_path, partitions, share

DICT_BYTES = 1 << 16       # size of the zstandard dictionary
SAMPLE_DOCS = 1_000        # documents it is trained on (about so many, by hash of doc_id and text) ...
SAMPLE_CHARS = 20_000      # ... of those no longer than this
LEVEL = 3
CHUNK_BYTES = 4 << 20
SLICE_BYTES = 2 << 20      # text tokenized at once in a task
CACHE_WORDS = 100_000      # words a task remembers
FRAMES = ("part int, chunk int, dict_hash string, payload binary, doc_id array<bigint>, "
          "offset array<bigint>, n_tokens array<bigint>, first_doc bigint, last_doc bigint")
_ENCODERS: dict[tuple, "Encoder"] = {}     # the worker process's own encoder


class Encoder:
    """Ids of whole texts by a tokenizers file (its path or its bytes), word by word with a bounded memory."""

    def __init__(self, source: str | bytes, end_id: int | None = 2, whole_texts: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(source) if isinstance(source, bytes) else Tokenizer.from_file(source)
        self.end = [] if end_id is None else [end_id]
        self.whole = whole_texts
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        top = max([self.tokenizer.get_vocab_size(with_added_tokens=True) - 1, *self.end])
        self.dtype = np.dtype("<u2" if top < 1 << 16 else "<u4")
        self.code = "H" if top < 1 << 16 else "I"
        self.young: dict[str, bytes] = {}     # two generations: words in use outlive the others
        self.old: dict[str, bytes] = {}

    def _lookup(self, words: list[str]) -> list[bytes]:
        young, old = self.young, self.old
        new = []
        for w in words:
            if w not in young:
                if w in old:
                    young[w] = old[w]
                else:
                    new.append(w)
        tokenize, code = self.tokenizer.model.tokenize, self.code
        other = []
        for w in new:
            if w.isascii() and w.isalpha() and w.islower():   # one piece that nothing rewrites
                young[w] = array(code, [t.id for t in tokenize(w)]).tobytes()
            else:
                other.append(w)
        for i in range(0, len(other), 2000):
            some = other[i:i + 2000]
            for w, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                young[w] = array(code, e.ids).tobytes()
        found = list(map(young.__getitem__, words))
        if len(young) > CACHE_WORDS:
            self.young, self.old = {}, young
        return found

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Serialised ids of each text, with the end id."""
        end = np.asarray(self.end, dtype=self.dtype).tobytes()
        if self.whole:
            return [array(self.code, e.ids).tobytes() + end for e in
                    self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
        lower = pc.ascii_lower(texts)
        if not any(pc.any(pc.match_substring(lower, t.lower())).as_py() for t in self.special):
            # fewer distinct words: the tokenizer lower-cases, and cuts between a letter and a sign
            texts = pc.replace_substring_regex(lower, r"([a-z])([.,:;!?%&$#*])", r"\1 \2")
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        vocab = self._lookup(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        at = words.indices.to_numpy(zero_copy_only=False)
        # a slice is a few MB, or one text of at most 2 GB: 32 bits count its ids
        n = np.fromiter(map(len, vocab), np.int32, len(vocab)) // self.dtype.itemsize
        first = np.cumsum(n, dtype=np.int32) - n
        flat = np.frombuffer(b"".join(vocab), self.dtype)
        count = n[at]
        stop = np.cumsum(count, dtype=np.int32)
        where = np.repeat(first[at] - (stop - count), count)
        where += np.arange(len(where), dtype=np.int32)
        raw = flat[where].tobytes()
        edge = np.r_[0, stop][split.offsets.to_numpy() - split.offsets[0].as_py()] * self.dtype.itemsize
        edge = edge.tolist()
        return [raw[i:j] + end for i, j in zip(edge[:-1], edge[1:])]


def encoder(content: bytes, end_id: int | None, whole_texts: bool) -> Encoder:
    """The worker process's own encoder: reused by the tasks that run in it one after another."""
    key = (hashlib.sha256(content).digest(), end_id, whole_texts)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(content, end_id, whole_texts)
    return _ENCODERS[key]


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of texts of about SLICE_BYTES."""
    if not len(texts):
        return
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    cut = np.flatnonzero(np.diff(size // SLICE_BYTES)) + 1
    for i, j in zip(np.r_[0, cut], np.r_[cut, len(texts)]):
        yield texts.slice(i, j - i)


def train_dictionary(serialised: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A zstandard dictionary; empty (plain frames) when there is too little to learn from."""
    import zstandard

    total = sum(map(len, serialised))
    if len(serialised) < 16 or total < 16 * 1024:
        return b""
    try:
        return zstandard.train_dictionary(min(size, total // 8), serialised, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def _zstd(dictionary: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def _sample(base: DataFrame, total: int) -> DataFrame:
    """The documents that the dictionary is trained on, copies of a row once."""
    return (base.filter(share(SAMPLE_DOCS, total, "doc_id", "text")).filter(F.length("text").between(1, SAMPLE_CHARS))
            .select("doc_id", "text").distinct().orderBy("doc_id", "text"))


def write_store(documents: DataFrame, path: str, tokenizer: str, end_id: int | None = 2,
                whole_texts: bool = False) -> None:
    """Tokenize ``documents`` (doc_id, text) and write their store at ``path``. ``tokenizer`` is a
    path on the driver; tasks get the bytes of that file."""
    spark = documents.sparkSession
    with open(tokenizer, "rb") as file:
        content = file.read()
    base = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sample = _sample(base, documents.count())
    local = Encoder(content, end_id, whole_texts)
    learn = pa.array([r.text for r in sample.select("text").collect()], pa.string())
    dictionary = train_dictionary([x for part in _slices(learn) for x in local.encode(part)])
    mark, width = hashlib.sha256(dictionary).hexdigest(), local.dtype.itemsize
    spark.createDataFrame([(mark, bytearray(dictionary), width)],
                          "dict_hash string, dictionary binary, width int").coalesce(1).write.parquet(
        f"{path}/dictionary")
    shared = spark.sparkContext.broadcast((dictionary, content))   # DICT_BYTES at most, and one tokenizer file

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        texts_to_ids = encoder(shared.value[1], end_id, whole_texts)
        squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=_zstd(shared.value[0]))
        part, chunk = None, 0
        docs: list = []
        frames: list[bytes] = []
        counts: list[int] = []
        held = 0

        def full() -> pa.RecordBatch:
            offset = np.r_[0, np.cumsum([len(x) for x in frames])].tolist()
            first = next((d for d in docs if d is not None), None)     # ascending, nulls first
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "chunk": pa.array([chunk], pa.int32()),
                "dict_hash": pa.array([mark]), "payload": pa.array([b"".join(frames)], pa.binary()),
                "doc_id": pa.array([docs], pa.list_(pa.int64())),
                "offset": pa.array([offset], pa.list_(pa.int64())),
                "n_tokens": pa.array([counts], pa.list_(pa.int64())),
                "first_doc": pa.array([first], pa.int64()), "last_doc": pa.array([docs[-1]], pa.int64())})

        for batch in batches:
            names = iter(batch.column("doc_id").to_pylist())
            if part is None and batch.num_rows:
                part = batch.column("part")[0].as_py()
            for texts in _slices(batch.column("text")):
                for x in texts_to_ids.encode(texts):
                    frame = squeeze.compress(x)
                    docs.append(next(names))
                    frames.append(frame)
                    counts.append(len(x) // width)
                    held += len(frame)
                    if held >= CHUNK_BYTES:
                        yield full()
                        chunk, held = chunk + 1, 0
                        docs, frames, counts = [], [], []
        if docs:
            yield full()

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    (base.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
     .select("doc_id", "text", F.spark_partition_id().alias("part"))
     .mapInArrow(pack, FRAMES)
     .write.option("compression", "uncompressed").parquet(f"{path}/frames"))


def _running(frames: DataFrame) -> DataFrame:
    """Chunks with the number of ids before each."""
    total = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x)
    chunks = frames.select("part", "chunk", total.alias("ids"))
    past = lambda w: F.coalesce(F.sum("ids").over(
        w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # parts: as many as the range exchange of the writer made
    parts = chunks.groupBy("part").agg(F.sum("ids").alias("ids")).select(
        "part", past(Window.orderBy("part")).alias("part_start"))
    return (chunks.withColumn("chunk_start", past(Window.partitionBy("part").orderBy("chunk")))
            .join(F.broadcast(parts), "part")
            .select("part", "chunk", (F.col("part_start") + F.col("chunk_start")).alias("chunk_start")))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the store: doc_id, start (ids of all documents before it), n_tokens and
    ids_crc32 (unsigned crc32 of its ids as little-endian unsigned 32-bit integers)."""
    head = spark.read.parquet(f"{path}/dictionary").first()
    mark, width = head.dict_hash, head.width
    if hashlib.sha256(bytes(head.dictionary)).hexdigest() != mark:
        raise ValueError("the dictionary does not have the hash it is stored with")
    shared = spark.sparkContext.broadcast(bytes(head.dictionary))
    frames = spark.read.schema(FRAMES).parquet(f"{path}/frames")
    starts = _running(frames)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        grow = zstandard.ZstdDecompressor(dict_data=_zstd(shared.value))
        for batch in batches:
            for row in range(batch.num_rows):
                cell = lambda c: batch.column(c)[row].as_py()  # noqa: B023, E731
                if cell("dict_hash") != mark:
                    raise ValueError("a chunk was written with another dictionary")
                payload, offset, docs = cell("payload"), cell("offset"), cell("doc_id")
                start, names, counts, sums, begins = cell("chunk_start"), [], [], [], []
                for i, name in enumerate(docs):
                    ids = np.frombuffer(grow.decompress(payload[offset[i]:offset[i + 1]]), f"<u{width}")
                    names.append(name)
                    counts.append(len(ids))
                    begins.append(start)
                    start += len(ids)
                    sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(names, pa.int64()), "start": pa.array(begins, pa.int64()),
                    "n_tokens": pa.array(counts, pa.int64()), "ids_crc32": pa.array(sums, pa.int64())})

    joined = frames.join(starts, ["part", "chunk"])
    return joined.mapInArrow(unpack, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def lookup(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of one document (one list per stored row of that doc_id): reads the chunks whose
    first and last doc_id enclose it, and decompresses its frame only."""
    import zstandard

    head = spark.read.parquet(f"{path}/dictionary").first()
    grow = zstandard.ZstdDecompressor(dict_data=_zstd(bytes(head.dictionary)))
    frames = spark.read.schema(FRAMES).parquet(f"{path}/frames")
    out = []
    around = (F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id)
    for row in frames.filter(around & F.array_contains("doc_id", F.lit(doc_id))).toLocalIterator():
        for i, name in enumerate(row.doc_id):
            if name == doc_id:
                raw = grow.decompress(bytes(row.payload)[row.offset[i]:row.offset[i + 1]])
                out.append(np.frombuffer(raw, f"<u{head.width}").tolist())
    return out


def digest(documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The query: write the store, read it back."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    spark = documents.sparkSession
    path = fresh_path(spark, "token_store")
    write_store(documents, path, tokenizer)
    return read_store(spark, path)
