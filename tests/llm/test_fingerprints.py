import hashlib
import random
import struct

import regex
import xxhash

from pyspark.sql import functions as F

from tallyhouse.llm import fingerprints as P
from tests.llm.docs import AWKWARD, SCHEMA, awkward, random_docs

UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"
PIECES = regex.compile(rf"(?V1)[a-z0-9ß-öø-ɏ]{{1,4}}|(?![\x00-ɏ])(?:[{UNSPACED}]|[[\p{{L}}\p{{M}}\p{{N}}]--[{UNSPACED}]]{{1,4}})")


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def chain(*values):
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(struct.pack("<q", v), h)
    return signed(h)


def marks(text):
    p = [signed(xxhash.xxh64_intdigest(x.encode(), 42)) for x in PIECES.findall((text or "").lower())]
    h = [chain(*p)] if len(p) == 1 else [chain(a, b) for a, b in zip(p, p[1:])]
    found = []
    for i in range(len(p) - P.K + 1):
        inner = h[i:i + P.K - P.S + 1]
        if min(inner) in (inner[0], inner[-1]):
            found.append((i, chain(inner[0], inner[2], inner[4])))
    return found or list(enumerate(h))


def text_of(m):
    return " ".join(f"{i}:{a & (1 << 64) - 1:X}" for i, a in m)


def jaccard(a, b):
    a, b = {x for _, x in a}, {x for _, x in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    rows = sorted(((d, t or "") for d, t, *_ in rows), key=lambda r: (
        r[0] is None, -(r[0] or 0), signed(xxhash.xxh64_intdigest(r[1].encode(), 42))))
    out = []
    for i, (d, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), text_of(marks(t)), text_of(marks(edited)),
                    jaccard(marks(t), marks(edited)), jaccard(marks(t), marks(after))))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, P.digest(df).collect()), key=str)


MIXED = [(100, "日本語の文章は空白がない。これは試験です。\U00020000\U00020001", None, None), (101, "!!! ???", None, None),
         (102, "ab", None, None), (103, "İstanbul ǅ ß naïve x́y", None, None)]


def test_brute_force(spark):
    rows = random_docs(300, 3, words=90) + MIXED
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_awkward_rows(spark):
    assert got(awkward(spark, extra="marks next _key at fingerprint")) == brute(AWKWARD)
    assert got(spark.createDataFrame([], SCHEMA)) == []
    one = [(7, "a single document of some words here", None, None)]
    assert got(spark.createDataFrame(one, SCHEMA)) == brute(one)
    same = [(1, "the same row over and over again", None, None)] * 40 + [(None, "no id", None, None)] * 40
    assert got(spark.createDataFrame(same, SCHEMA).repartition(4)) == brute(same)


def test_very_long_text(spark):
    r = random.Random(1)
    text = " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(1, 9))) for _ in range(80_000))
    rows = [(1, text, None, None), (2, text[200_000:], None, None), (3, "x" * 600_000, None, None)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_anchors_are_free_of_context():
    r = random.Random(5)
    words = lambda n: " ".join("".join(r.choice("abcdefghijkl") for _ in range(r.randint(2, 8))) for _ in range(n))
    for _ in range(20):
        common = words(60)
        inside = {a for _, a in marks(common)}
        other = {a for _, a in marks(words(13) + " " + common + " " + words(29))}
        assert inside <= other


def test_shifted_copies_align(spark):
    rows = random_docs(40, 8, words=200)
    pairs = [(i, t, " ".join(["lead"] * (i % 7)) + " " + t + " and a tail") for i, t, *_ in rows if len(t) > 100]
    df = spark.createDataFrame(pairs, "id long, x string, y string").select(
        "id", P.fingerprint(F.col("x")).alias("a"), P.fingerprint(F.col("y")).alias("b"))
    for r in P.aligned(df, "id").collect():
        a, b = (marks(t) for t in next(p[1:] for p in pairs if p[0] == r.id))
        votes = {}
        for i, x in a:
            for s in {j - i for j, y in b if y == x}:
                votes.setdefault(s, []).append(i)
        best = max(votes, key=lambda s: (len(votes[s]), -abs(s), -s))
        assert (r["shift"], r.matched, r.from_at, r.to_at) == (best, len(votes[best]), min(votes[best]), max(votes[best]))
        assert r["shift"] == r.id % 7


def test_columns_pass(spark):
    df = P.fingerprinted(awkward(spark, extra="marks other"))
    assert df.columns == ["doc_id", "text", "lang", "source", "other", "marks"] and df.count() == len(AWKWARD)


def test_no_python_in_the_plan(spark):
    plan = P.digest(awkward(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
