import random
import re

import numpy as np

from tallyhouse.llm import ngram_join
from tests.llm.docs import AWKWARD, SCHEMA, awkward, random_docs


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def shingles(text):
    w = words_of(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    pairs = {(i, j) for g in where.values() for i in g for j in g if i < j}
    for i, j in pairs:
        both = len(sets[i] & sets[j])
        if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), least.get(find(i))) for i, r in enumerate(rows)), key=str)


def near_copies(seed=0):
    """Texts of all lengths with copies at many similarities, chains, a large group of near
    copies of one text, and one passage in many otherwise different texts."""
    r = random.Random(seed)
    rows = random_docs(150, seed, words=90)
    vocab = [w for x in rows for w in x[1].split()]
    out = list(rows)

    def change(text, edits):
        w = text.split()
        for _ in range(edits):
            k = r.randrange(len(w))
            w[k:k + 1] = r.choice([[], [r.choice(vocab)], [w[k], r.choice(vocab)]]) if len(w) > 1 else [r.choice(vocab)]
        return " ".join(w)

    for _, text, *_ in rows:
        for edits in range(1, 1 + len(text.split()) // 15):
            out.append((len(out), change(text, edits), "en", "s"))
    base = " ".join(r.choice(vocab) for _ in range(120))
    out += [(len(out) + i, change(base, 1 + i % 2), "en", "s") for i in range(40)]
    step = base
    for i in range(12):
        step = change(step, 1)
        out.append((len(out), step + " end", "en", "s"))
    passage = " ".join(r.choice(vocab) for _ in range(50))
    out += [(len(out) + i, passage + " " + " ".join(r.choice(vocab) for _ in range(r.randint(3, 60))), "en", "s")
            for i in range(60)]
    out += [(len(out) + i, base.upper() if i % 2 else " " + base.replace(" ", "\n"), "en", "s") for i in range(20)]
    return [(i, *x[1:]) for i, x in enumerate(out)]


def test_blocks_lose_no_pair():
    r = np.random.default_rng(0)
    for _ in range(1500):
        n = int(r.integers(4, 400))
        a = r.integers(0, 1 << 63, n, dtype=np.uint64)
        d = int(r.integers(0, n // 4 + 2))
        cut = int(r.integers(0, d + 1))
        b = np.r_[a[cut:], r.integers(0, 1 << 63, d - cut, dtype=np.uint64)]
        if len(b) == 0 or 100 * (n - cut) < 80 * (n + d - cut):
            continue
        a, b = np.unique(a), np.unique(b)
        owner, keys = ngram_join.block_keys(np.r_[a, b], np.array([0, len(a), len(a) + len(b)]))
        assert set(keys[owner == 0]) & set(keys[owner == 1])
        p = ngram_join.parity(np.r_[a, b], np.array([0, len(a), len(a) + len(b)]))
        assert sum(int(x).bit_count() for x in p[0] ^ p[1]) <= d


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.digest(df).collect()), key=str)


def test_brute_force(spark):
    rows = near_copies()
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(4)) == brute(rows)


def test_no_hubs_at_all(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "ROUNDS", 0)
    rows = near_copies(1)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_awkward_rows(spark):
    assert got(awkward(spark, extra="key cid")) == brute(AWKWARD)
    assert got(spark.createDataFrame([], SCHEMA)) == []


def test_test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got(df) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_first_rows(spark):
    out = ngram_join.linked_rows(awkward(spark, extra="n_chars _n _first"))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "_n", "n_shingles", "component_id", "_first"]
    first = out.filter("_first").collect()
    assert len(first) == out.select("component_id", "n_shingles").filter("n_shingles > 0").distinct().count() + 3
