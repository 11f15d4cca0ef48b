import random
import zlib

import numpy as np
import pytest

from tallyhouse.llm import toxicity
from tests.llm.docs import SCHEMA, awkward, random_docs

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=400, seed=1):
    r = random.Random(seed)
    rows, labels = [], []
    for i, text, lang, source in random_docs(n, seed):
        bad = r.random() < 0.3
        words = text.split()
        for _ in range(3 if bad else 0):
            words.insert(r.randrange(len(words) + 1), r.choice(["idiot", "MORON!", "zorgle", "pathet1c"]))
        rows.append((i, " ".join(words), lang, source))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_isotonic_is_the_best_monotone_fit():
    r = np.random.default_rng(0)
    m, y = r.normal(size=40), (r.random(40) < 0.4).astype(float)
    x, p = toxicity.isotonic(m, y)
    assert (np.diff(x) >= 0).all() and (np.diff(p) >= -1e-12).all()
    s = np.argsort(m)
    fit, ys = np.interp(m[s], x, p), y[s]
    brute = [max(min(ys[i:j + 1].mean() for j in range(k, 40)) for i in range(k + 1)) for k in range(40)]
    assert np.allclose(fit, brute)


def test_trees_learn_an_interaction():
    r = np.random.default_rng(0)
    x = r.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    m = toxicity.Trees(x, y).margins(x)
    assert ((m > 0) == (y > 0.5)).mean() > 0.97


def test_features_against_plain_python():
    lexicon = toxicity.Lexicon(["zorgle"])
    text = "You IDIOT! really, 1d10t zorgle? and  so on m.o.r.o.n"
    x = dict(zip(toxicity.FEATURES, toxicity.features([text, "", "plain words"], lexicon)[0]))
    assert x["insults"] == pytest.approx(3 / 9) and x["mined"] == pytest.approx(1 / 9)
    assert x["hidden"] == pytest.approx(2 / 9) and x["hits"] == pytest.approx(np.log(5))
    assert x["second"] == pytest.approx(1 / 9) and x["near_second"] == pytest.approx(3 / 4)
    assert x["exclaim"] == pytest.approx(1 / 9) and x["upper_words"] == pytest.approx(1 / 9)
    assert not toxicity.features([""], lexicon)[0][:14].any()


def test_batches_do_not_matter():
    lexicon = toxicity.Lexicon([])
    texts = [r[1] for r in random_docs(40, 2)] + ["", "you idiot " * 500]
    one = np.concatenate([toxicity.features([t], lexicon) for t in texts])
    assert np.allclose(one, toxicity.features(texts, lexicon))


def test_held_out_documents(spark):
    rows, labels = corpus()
    docs, lab = spark.createDataFrame(rows, SCHEMA).repartition(4), spark.createDataFrame(labels, LABELS)
    out = toxicity.digest(docs, lab).collect()
    truth = {d: t for d, _, t in labels}
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)


def test_held_out_labels_are_not_learned(spark):
    rows, labels = corpus(200)
    flipped = [(d, q, 1 - t if zlib.crc32(str(d).encode()) % 4 == 2 else t) for d, q, t in labels]
    docs = spark.createDataFrame(rows, SCHEMA)
    a, b = (sorted(map(tuple, toxicity.digest(docs, spark.createDataFrame(x, LABELS)).collect()))
            for x in (labels, flipped))
    assert a == b


def test_awkward_rows(spark):
    df = awkward(spark, extra="toxic n_chars")
    rows, labels = corpus()
    lab = spark.createDataFrame([(10_000 + d, q, t) for d, q, t in labels] + [(None, 1, 1), (1, None, None), (1, 0, 0)], LABELS)
    docs = spark.createDataFrame([(10_000 + r[0], *r[1:]) for r in rows], SCHEMA)
    model = toxicity.learn(docs.unionByName(df.select(*docs.columns)), lab)
    out = toxicity.score(df, model)
    assert out.columns == df.columns + ["score", "predicted"] and out.count() == 14
    assert all(r.predicted == 0 for r in out.collect())
    none = toxicity.digest(df, spark.createDataFrame([], LABELS)).collect()
    assert len(none) == 14 and all(r.score == 0 and r.predicted == 0 for r in none)
    assert toxicity.digest(spark.createDataFrame([], SCHEMA), lab).collect() == []
    clash = toxicity.score(awkward(spark, extra="score rest"), model)
    assert clash.columns == ["doc_id", "text", "lang", "source", "rest", "score", "predicted"]
    assert clash.filter("score < 1 and rest = 1").count() == 14
