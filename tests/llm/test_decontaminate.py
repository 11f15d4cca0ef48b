import itertools
import random
import re

from tallyhouse.llm import decontaminate as D
from tests.llm.docs import SCHEMA, awkward, random_docs

ITEMS = "item_id long, text string"


def toks(text):
    apart = re.sub("([\u3040-\u30ff\u4e00-\u9fff\u0e00-\u0e7f])", r" \1 ", (text or "").lower())
    return [t for t in re.split(r"[\W_]+", apart) if t]


def brute(docs, items):
    out = set()
    for d, text, *_ in docs:
        h = toks(text)
        for item, body in items:
            t = toks(body)
            w = min(D.WINDOW, len(t))
            if not t:
                continue
            allowed = D.SUBSTITUTIONS if len(t) >= D.WINDOW else 0
            for i in range(len(h) - w + 1):
                for j in range(len(t) - w + 1):
                    if sum(a != b for a, b in zip(h[i:i + w], t[j:j + w])) <= allowed:
                        out.add((d, item))
    return out


def test_masks_hit_every_stretch():
    for phase in range(D.STEP):
        for bad in itertools.combinations(range(D.WINDOW), D.SUBSTITUTIONS):
            assert any((s + phase) % D.STEP == 0 and not {s + p for p in m} & set(bad)
                       for m in D.MASKS for s in range(D.WINDOW - D.SPAN + 1))
    assert all(max(m) == D.SPAN - 1 and D.SPAN + D.STEP - 1 <= D.SPAN + 1 for m in D.MASKS)


def planted(seed=0):
    r = random.Random(seed)
    docs = [list(x) for x in random_docs(200, seed, words=80)]
    items = [(i, " ".join(x[1].split()[:n])) for i, (x, n) in enumerate(zip(random_docs(300, seed + 9, words=60)[::6],
                                                                         itertools.cycle([60, 7, 9, 12, 13, 20, 8, 3])))]
    for d in docs[::2]:
        body = r.choice(items)[1].split()
        k = r.randrange(len(body))
        body = body[k // 3:]
        for _ in range(r.randrange(5)):
            body[r.randrange(len(body))] = "zzz"
        if r.random() < 0.3:
            body = [w.upper() + "%%%" for w in body]
        w = d[1].split()
        at = r.randrange(len(w) + 1)
        d[1] = " ".join(w[:at] + body + w[at:])
    docs += [[500, "前日本語の文章は空白がない試験です後", "ja", "s"], [501, "日本語の文 章は空白がない試験", "ja", "s"], [502, "日本語x", "ja", "s"]]
    items += [(800, "日本語の文章は空白がない試験"), (801, "試験"), (802, "章は空白が")]
    return [tuple(d) for d in docs], items + [(900, None), (901, ""), (0, items[0][1])]


def test_brute_force(spark, monkeypatch):
    docs, items = planted()
    want = brute(docs, items)
    df, bench = spark.createDataFrame(docs, SCHEMA).repartition(3), spark.createDataFrame(items, ITEMS)
    rows = D.digest(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want and len(rows) == len(want) > 20
    text = {d[0]: toks(d[1]) for d in docs}
    body = dict(reversed([(i, toks(t)) for i, t in items]))
    for r in rows:
        t = body[r.item_id]
        w = min(len(t), D.WINDOW)
        here = text[r.doc_id][r.position:r.position + w]
        assert max(sum(a == b for a, b in zip(here, t[j:j + w])) for j in range(len(t) - w + 1)) == r.matched
    monkeypatch.setattr(D, "SEEDS", 300)
    assert {(r.doc_id, r.item_id) for r in D.digest(df, bench).collect()} == want
    left = D.clean(df, bench)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({d[0] for d in docs} - {d for d, _ in want})


def test_awkward_rows(spark):
    df = awkward(spark, extra="item_id seed h")
    bench = spark.createDataFrame([(1, "word " * 20), (2, None), (3, "")], ITEMS)
    rows = D.digest(df, bench).collect()
    assert [(r.doc_id, r.item_id, r.matched, r.position) for r in rows] == [(8, 1, 13, 0)]
    assert D.clean(df, bench).count() == 12
    none = spark.createDataFrame([], ITEMS)
    assert D.digest(df, none).collect() == [] and D.clean(df, none).count() == 14
    assert D.digest(spark.createDataFrame([], SCHEMA), bench).collect() == []
