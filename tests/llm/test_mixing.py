import re

import numpy as np

from tallyhouse.llm import mixing
from tests.llm.docs import SCHEMA, awkward, random_docs


def brute_targets(sizes):
    """Share, stop at 3 times the size, reshare the excess by weight, again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(3 * sizes[s] for s in full)
        share = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = {s for s in rest if share[s] > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in full else share[s] for s in names}
        full |= over


def check(rows, tolerance):
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    targets = brute_targets({s: sum(r["size"] for r in x) for s, x in by.items()})
    for s, x in by.items():
        total = sum(r["size"] for r in x)
        assert all(r.source_size == total and abs(r.target - targets[s]) <= 1e-6 * max(1, total) for r in x)
        assert all(r.taken == r.copies * r["size"] <= 3 * r["size"] for r in x)
        assert abs(sum(r.taken for r in x) - targets[s]) <= tolerance


def test_flight_keeps_both_totals():
    r = np.random.default_rng(1)
    pi, size, draw = r.random(500), r.integers(0, 900, 500).astype(float), r.random(500)
    out = mixing.fly(pi, size, draw)
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert abs(out.sum() - pi.sum()) < 1e-6 and abs((out * size).sum() - (pi * size).sum()) < 1e-3


def test_inclusion_probabilities_hold():
    r = np.random.default_rng(2)
    pi, size = r.random(9), r.integers(1, 50, 9).astype(float)
    mean = np.mean([mixing.fly(pi, size, r.random(9)) for _ in range(4000)], axis=0)
    assert np.abs(mean - pi).max() < 0.04


def test_targets_met(spark):
    rows = random_docs(3000, words=80)
    out = mixing.digest(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert len(out) == 3000
    assert {r.doc_id: r["size"] for r in out} == {x[0]: len(re.findall(r"[^\x20\x09-\x0D]+", x[1])) for x in rows}
    check(out, 5)


def test_heavy_documents(spark):
    """Sources with documents of a tenth and more of their words still meet their targets within the
    size of a median document."""
    r = np.random.default_rng(4)
    rows = []
    for k, heavy in enumerate([[], [20_000], [9_000, 15_000, 31_000], [4_000] * 9, [70_000]]):
        sizes = [*heavy, *(int(x) for x in r.lognormal(5, 1, 400))]
        rows += [(1000 * k + i, "w " * n, "en", f"s{k}") for i, n in enumerate(sizes)]
    check(mixing.digest(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect(), 150)


def test_many_buckets_and_reruns(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 100)
    monkeypatch.setattr(mixing, "MERGE", 4)
    rows = [(i, t, lang, "hot" if i % 3 else s) for i, t, lang, s in random_docs(2500, 3, 6)]
    a = mixing.digest(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    b = mixing.digest(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()
    check(a, 60)
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_awkward_rows(spark):
    out = mixing.digest(awkward(spark, extra="n_chars")).collect()
    assert len(out) == 14
    sizes = {}
    for r in out:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    targets = brute_targets(sizes)
    assert all(abs(r.target - targets[r.source]) < 1e-6 * max(1, r.target) for r in out)
    assert all(r.taken <= 3 * r["size"] for r in out)
    assert mixing.digest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_mix_returns_whole_rows(spark):
    df = awkward(spark, extra="n_chars")
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns + ["size", "source_size", "target", "copies"]
    rows = mixing.repeated(mixed, df.columns)
    assert rows.columns == df.columns
    assert rows.count() == sum(r.copies for r in mixed.collect())
    clash = mixing.mix(awkward(spark, extra="target _rid rest"))
    assert clash.columns == [*df.drop("n_chars").columns, "_rid", "rest", "size", "source_size", "target", "copies"]
    assert clash.filter("_rid = 1 and rest = 1").count() == 14 and clash.filter("target <> 1").count() > 0
