import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from tallyhouse.llm import periodic_runs as R
from tests.llm.docs import AWKWARD, SCHEMA, awkward, random_docs


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_runs(w, least=24, repeats=3):
    """Every maximal stretch for every period, smallest period per stretch."""
    out = {}
    for q in range(1, len(w) // repeats + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, repeats * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1) if j > i else i + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def plant(d, text):
    w = split(text)
    h = None if d is None else zlib.crc32(str(d).encode())
    if h is None or h % 10 or not w:
        return w
    g = h // 10
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    out = []
    for d, text, *_ in rows:
        w = plant(d, text)
        runs = brute_runs(w)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        out.append((d, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                    sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
                    sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, R.digest(df).collect()), key=str)


def periodic_docs(n, seed):
    """Texts made of periodic stretches that touch, overlap and nest, and of small alphabets."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        words = []
        for _ in range(r.randint(1, 5)):
            root = [r.choice("ab") if r.random() < 0.7 else f"w{r.randrange(40)}" for _ in range(r.choice([1, 2, 3, 5, 8, 13, 40]))]
            root = root * r.choice([1, 1, 2, 3]) + root[:r.randrange(len(root) + 1)]
            words += (root * r.randint(1, 12))[:r.randint(1, 160)]
        out.append((i * 7919, " ".join(words), "en", "s"))
    return out


def test_factors_find_all_runs():
    r = random.Random(2)
    for _ in range(300):
        w = [r.choice("ab") for _ in range(r.randint(0, 120))]
        for least, repeats in ((24, 3), (6, 3), (4, 4)):
            assert [tuple(x) for x in R.find([w], least, repeats)[0].tolist()] == brute_runs(w, least, repeats)
    lists = [split(t) for _, t, *_ in periodic_docs(300, 3)]
    for got_, w in zip(R.find(lists), lists):
        assert [tuple(x) for x in got_.tolist()] == brute_runs(w)


def test_brute_force(spark):
    rows = periodic_docs(400, 1) + [(d + 5_000_000, *x) for d, *x in random_docs(300, 9, words=150)]
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_awkward_rows(spark):
    rows = AWKWARD + [(i, t, None, None) for i, t in ((30, "a b " * 30), (31, " x y " * 40), (32, "z\x1fz " * 24),
                                                      (33, "z " * 23), (None, "q r " * 50))]
    assert got(awkward(spark, rows, extra="runs collapsed n_words best a p w g")) == brute(rows)
    assert got(spark.createDataFrame([], SCHEMA)) == []


def test_columns_pass(spark):
    df = R.periodic(awkward(spark, extra="runs other"))
    assert df.columns == ["doc_id", "text", "lang", "source", "other", "n_words", "runs", "collapsed"]
    rows = {r.doc_id: r for r in df.collect()}
    assert rows[2].runs == [] and rows[2].collapsed == "" and rows[2].text is None and rows[2].other == 1
    assert [tuple(x) for x in rows[8].runs] == [(0, 6000, 1)] and rows[8].collapsed == "word"


def test_very_long_text(spark):
    r = random.Random(4)
    words = [f"u{r.randrange(10 ** 6)}" for _ in range(300_000)]
    words[50_000:50_000] = (words[:20_000] * 4)[:70_001]
    words[200:200] = ["x"] * 100_000
    row = R.periodic(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).first()
    found = [tuple(x) for x in row.runs]
    assert (200, 100_000, 1) in found and all(n >= 3 * q for _, n, q in found)
    for s, n, q in found:
        assert words[s:s + n - q] == words[s + q:s + n]
        assert s == 0 or words[s - 1] != words[s - 1 + q]
        assert s + n == len(words) or words[s + n] != words[s + n - q]
    assert any(n >= 70_001 and q == 20_000 + 0 for _, n, q in found) or len(found) == 1


def test_strongest_is_exact(spark):
    runs = [[(5, 300, 100), (9, 30, 10), (2, 27, 9)], [(0, 3000001, 1000000), (4, 3, 1)], []]
    df = spark.createDataFrame([(x,) for x in runs], f"runs {R.RUNS}")
    best = [r.b for r in df.select(R.strongest(df.runs).alias("b")).collect()]
    assert [b and tuple(b) for b in best] == [(2, 27, 9), (0, 3000001, 1000000), None]


def test_slices_do_not_matter(monkeypatch):
    lists = [split(t) for _, t, *_ in periodic_docs(50, 6)]
    whole = [x.tolist() for x in R.find(lists)]
    monkeypatch.setattr(R, "SLICE_WORDS", 40)
    assert [x.tolist() for part in R._slices(iter(lists)) for x in R.find(part)] == whole
    assert all(isinstance(x, np.ndarray) for x in R.find([[]]))
