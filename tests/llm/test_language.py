import random
import zlib

import numpy as np
import pytest

from tallyhouse.llm import language
from tests.llm.docs import SCHEMA, awkward

SYLLABLES = {"xx": ["tha", "ing", "er", "the"], "yy": ["eau", "que", "oi", "é"]}


def texts(n, seed=0):
    r = random.Random(seed)
    return [(i, " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(3)) for _ in range(r.randint(5, 60))),
             lang, "s") for i in range(n) for lang in [r.choice(["xx", "yy"])]]


@pytest.fixture(scope="module", autouse=True)
def small():
    old = language.STEPS
    language.ByteGRU.train.__defaults__ = (60, 2)
    yield
    language.ByteGRU.train.__defaults__ = (old, 2)


def test_gradients_by_differences():
    net = language.ByteGRU(["a", "b", "c"], hidden=4)
    r = np.random.default_rng(0)
    data, want = r.integers(0, 256, (7, 5)).astype(np.uint8), r.integers(0, 3, 5)
    _, grads = net.gradients(data, want)
    for k, g in grads.items():
        for _ in range(6):
            at = tuple(r.integers(0, s) for s in g.shape)
            if k[0] == "x":
                at = (at[0], data[r.integers(0, 7), r.integers(0, 5)])
            keep = net.p[k][at]
            net.p[k][at] = keep + 1e-5
            up = net.gradients(data, want)[0]
            net.p[k][at] = keep - 1e-5
            down = net.gradients(data, want)[0]
            net.p[k][at] = keep
            assert abs((up - down) / 2e-5 - g[at]) < 1e-6


def test_prediction_equals_the_training_network():
    net = language.ByteGRU(["a", "b", "c"], hidden=5)
    raw = [bytes(np.random.default_rng(i).integers(0, 256, n).astype(np.uint8)) for i, n in enumerate([1, 5, 40, 41, 0, 100])]
    got = language.document_probabilities(net.ready(), raw, window=20)
    for x, have in zip(raw, got):
        total = np.zeros(3)
        for i in range(0, len(x), 20):
            data = np.frombuffer(x[i:i + 20], np.uint8)[:, None]
            f, _ = net._run(data, "f")
            b, _ = net._run(data[::-1], "b")
            z = net.p["of"] @ f + net.p["ob"] @ b[::-1] + net.p["b"]
            e = np.exp(z)
            total += (e / e.sum(axis=1, keepdims=True)).sum(axis=(0, 2))
        assert np.allclose(have, total / max(1, len(x)), atol=1e-4)


def test_held_out_accuracy(spark):
    rows = texts(300)
    out = language.digest(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    lang = {r[0]: r[2] for r in rows}
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in out)


def test_held_out_languages_are_not_learned(spark):
    rows = [(i, t, "secret" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, s) for i, t, lang, s in texts(60)]
    assert "secret" not in language.train(spark.createDataFrame(rows, SCHEMA)).classes


def test_awkward_rows(spark):
    df = awkward(spark, extra="n_chars")
    out = {r.doc_id: r for r in language.digest(df).collect()}
    assert out[2].lang_pred == out[3].lang_pred == out[4].lang_pred == "und" and out[2].score == 0
    assert out[7].lang_pred in ("en", "fr")
    assert language.digest(df).count() == 14
    assert language.digest(spark.createDataFrame([], SCHEMA)).collect() == []
    marks = spark.createDataFrame([(1, "12 345 !!", "en", "s")], SCHEMA)
    assert language.digest(marks).first().lang_pred == "und"
    net = language.train(df)
    for model in (net, None):
        clash = language.identify(awkward(spark, extra="score _letters"), model)
        assert clash.columns == ["doc_id", "text", "lang", "source", "_letters", "lang_pred", "score"]
        assert clash.filter("score = 0 and _letters = 1").count() >= 3
