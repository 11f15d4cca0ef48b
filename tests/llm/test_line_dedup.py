import random

from pyspark.sql import functions as F

from tallyhouse.llm import line_dedup
from tests.llm.docs import SCHEMA, awkward, random_docs


def normal(line):
    return line.strip(" \t\r\f\x0b").lower()


def sets(line):
    k = line_dedup.SHINGLE
    return {line[i:i + k] for i in range(len(line) - k + 1)} if len(line) >= k else {line}


def brute(rows):
    """(doc_id, line number) -> component, by comparing every pair of distinct lines."""
    places = [(d, p, normal(x)) for d, t, *_ in rows if t is not None for p, x in enumerate(t.split("\n"))
              if normal(x)]
    distinct = sorted({x for *_, x in places})
    shingle = [sets(x) for x in distinct]
    root = list(range(len(distinct)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = []
    for i in range(len(distinct)):
        for j in range(i):
            both = len(shingle[i] & shingle[j])
            if 100 * both >= line_dedup.LINK * (len(shingle[i]) + len(shingle[j]) - both):
                links.append((i, j))
                root[find(i)] = find(j)
    at = {x: find(i) for i, x in enumerate(distinct)}
    return places, at, links, distinct


def corpus(seed=0):
    r = random.Random(seed)
    base = [x[1] for x in random_docs(160, seed, words=60)]
    letters = "abcdefgh "

    def change(line, edits):
        c = list(line)
        for _ in range(edits):
            i = r.randrange(len(c))
            c[i:i + 1] = r.choice([[], [r.choice(letters)], [c[i], r.choice(letters)]])
        return "".join(c) or "x"

    lines = base + [change(x, 1 + i % 4) for i, x in enumerate(base)] + [change(base[0], 2) for _ in range(30)]
    passage = base[3] + " " + base[4]
    lines += [passage + " " + r.choice(base) for _ in range(30)] + ["", "  ", "Menu", "menu ", "MENU"] * 10
    lines += ["".join(r.choice("abcdefgh") for _ in range(200)) for _ in range(4)]
    lines += [change(x, 1) for x in lines[-4:]] + [x.upper() + "\r" for x in base[:20]]
    r.shuffle(lines)
    return [(i, "\n".join(lines[k:k + 5]), "en", "s") for i, k in enumerate(range(0, len(lines), 5))]


def test_recall_and_precision(spark):
    hit = total = 0
    for seed in (0, 1, 2):
        rows = corpus(seed)
        places, at, links, distinct = brute(rows)
        out = line_dedup.digest(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
        comp = {(r.doc_id, r.line_no): (r.keep_doc_id, r.keep_line_no) for r in out}
        assert len(out) == len(places) == len(comp)
        label = {x: comp[d, p] for d, p, x in places}
        # equal lines always meet, links that were found are true
        assert all(label[x] == comp[d, p] for d, p, x in places)
        merged = {}
        for x in distinct:
            merged.setdefault(label[x], set()).add(at[x])
        assert all(len(v) == 1 for v in merged.values())
        total += len(links)
        hit += sum(label[distinct[i]] == label[distinct[j]] for i, j in links)
        # the line kept is the first of its component
        for r in out:
            assert r.kept == ((r.doc_id, r.line_no) == (r.keep_doc_id, r.keep_line_no))
            assert (r.keep_doc_id, r.keep_line_no) <= (r.doc_id, r.line_no)
        assert sum(r.kept for r in out) == len(set(comp.values()))
    assert total > 400 and hit / total >= 0.97, (hit, total)


def links_met(spark, lines):
    """(true links, those whose lines ended up in one component)."""
    rows = [(i, x, "en", "s") for i, x in enumerate(lines)]
    places, _, links, distinct = brute(rows)
    comp = {r.doc_id: r.keep_doc_id for r in line_dedup.digest(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    label = {x: comp[d] for d, _, x in places}
    return len(links), sum(label[distinct[i]] == label[distinct[j]] for i, j in links)


def test_near_copies_in_a_group_of_one_passage(spark):
    r = random.Random(5)
    word = lambda a, b: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(a, b)))
    text = lambda n: " ".join(word(3, 8) for _ in range(n))[:n]
    passage, lines = text(400), []
    for _ in range(250):
        own = text(r.randint(60, 100)).split(" ")
        at = r.randrange(len(own))
        lines += [passage + " " + " ".join(own), passage + " " + " ".join(own[:at] + [word(3, 6)] + own[at:])]
    r.shuffle(lines)
    total, hit = links_met(spark, lines)
    assert total >= 250 and hit == total, (hit, total)


def test_short_and_unspaced_lines(spark):
    r = random.Random(9)
    some = lambda letters, n: "".join(r.choice(letters) for _ in range(n))
    script = "".join(chr(0x4E00 + i) for i in range(400))
    lines = ["ab" * 12, "ab" * 40, "= " * 15, "= " * 70]
    for n in range(12, 46):
        for _ in range(6):
            spaced = some("abcdefghijklmnopqrst    ", n).strip() or "x"
            for x in (spaced, some(script, n)):
                at = r.randrange(len(x))
                lines += [x, r.choice([x + some(script, 1), some(script, 1) + x, x[:at] + some(script, 1) + x[at:]])]
    r.shuffle(lines)
    total, hit = links_met(spark, lines)
    assert total > 200 and hit >= 0.99 * total, (hit, total)


def test_bounds_of_the_exact_round_lose_no_link(spark):
    distinct = sorted({normal(x) for row in corpus(1) for x in row[1].split("\n") if normal(x)})
    shingle = [sets(x) for x in distinct]
    want = {(j, i) for i in range(len(distinct)) for j in range(i)
            if 100 * len(shingle[i] & shingle[j]) >= line_dedup.LINK * len(shingle[i] | shingle[j])}
    facts = line_dedup._facts(spark.createDataFrame(list(enumerate(distinct)), "cid long, line string"))
    assert {r.cid: r.n for r in facts.select("cid", "n").collect()} == {i: len(x) for i, x in enumerate(shingle)}
    for many in (10, 5000):
        full = facts.withColumns({"key": F.lit(1), "many": F.lit(many), "comp": F.col("cid")})
        got = [(r.a, r.b) for r in line_dedup._crossing(full).collect()]
        assert want <= set(got) and len(got) == len(set(got))


def test_a_pair_of_many_groups_is_met_once(spark):
    lines = [("x" * i + " the same line of several words %d" % i) for i in range(6)]
    facts = line_dedup._facts(spark.createDataFrame(list(enumerate(lines)), "cid long, line string"))
    groups = [(k, i, 9) for k in range(4) for i in range(6) if k != i]
    full = spark.createDataFrame(groups, "key long, cid long, many long").withColumn("comp", F.col("cid")).join(facts, "cid")
    x, y = full.alias("x"), full.alias("y")
    join = line_dedup._crossing(full)
    got = sorted((r.a, r.b) for r in join.collect())
    want = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.cid") < F.col("y.cid")) & line_dedup._allowed("x", "y"))
    assert got == sorted({tuple(r) for r in want.select("x.cid", "y.cid").collect()}) and got
    # no row is made twice and thrown away behind the join
    assert "HashAggregate(keys=[a" not in join._jdf.queryExecution().toString()


def test_compared_sets_are_the_shingles(spark):
    lines = ["", "a", "abcdefg", "abcdefgh", "abcdefghi", "x" * 200, "caf\u00e9 \u4e2d\u6587 \U0001f600 and a tail", "\U0001f600" * 9, "\u4e2d" * 7]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string").select("i", line_dedup.compared(F.col("line")).alias("s"))
    for r in df.collect():
        line = lines[r.i]
        assert len(r.s) == max(1, len(line) - line_dedup.SHINGLE + 1) and len(set(r.s)) == len(sets(line))
    pairs = spark.createDataFrame([("caf\u00e9 and more", "a caf\u00e9 and so"), ("abcdefgh\u00e9", "abcdefghi")], "a string, b string").select(
        "a", "b", F.size(F.array_intersect(line_dedup.compared(F.col("a")), line_dedup.compared(F.col("b")))).alias("n")).collect()
    assert all(r.n == len(sets(r.a) & sets(r.b)) for r in pairs) and [r.n for r in pairs] == [2, 1]


def test_bitmap_loses_no_key_and_keeps_others_out(spark):
    lines = spark.range(4000).selectExpr("id - 7 AS _id", "cast(id AS string) AS line")
    wanted = lines.filter("_id % 9 = 0").selectExpr("_id AS cid").union(spark.sql("SELECT 1L << 40")).coalesce(2)
    want = {r.cid for r in wanted.collect()} & set(range(-7, 3993))
    bitmap = line_dedup._bitmap(wanted, "cid")
    rows = lines.withColumnRenamed("_id", "cid")
    inside = [r.cid for r in line_dedup._maybe(rows, "cid", bitmap).collect()]
    outside = [r.cid for r in line_dedup._maybe(rows, "cid", bitmap, False).collect()]
    assert want <= set(inside) and len(inside) <= len(want) + 5
    assert sorted(inside + outside) == list(range(-7, 3993))
    assert {(r.cid, r.line) for r in line_dedup._texts(lines, wanted).collect()} == {(i, str(i + 7)) for i in want}


def test_shingles_over_the_ends_of_pieces(spark):
    r = random.Random(3)
    lines = ["".join(r.choice("ab\u00e9\u4e2d\U0001f600 ") for _ in range(n)) for n in [*range(1, 12), *range(60, 76), *range(124, 140), 3000]]
    lines += ["x" * 500, "ab" * 100]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    every = sorted(set().union(*map(sets, lines)))
    hashes = {r.s: r.h for r in spark.createDataFrame([(x,) for x in every], "s string").withColumn("h", F.xxhash64("s")).collect()}
    for row in df.select("i", line_dedup.shingles(F.col("line")).alias("s")).collect():
        assert len(row.s) == len(set(row.s)) and set(row.s) == {hashes[x] for x in sets(lines[row.i])}


def test_texts_lose_the_dropped_lines(spark):
    rows = corpus(2)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    gone = {(r.doc_id, r.line_no) for r in line_dedup.digest(df).filter("not kept").collect()}
    want = {d: "\n".join(x for p, x in enumerate(t.split("\n")) if (d, p) not in gone) for d, t, *_ in rows}
    out = line_dedup.dedup_lines(df)
    assert out.columns == df.columns and {r.doc_id: r.text for r in out.collect()} == want


def test_awkward_rows(spark):
    df = awkward(spark, extra="key line")
    out = line_dedup.digest(df).collect()
    assert all(r.doc_id not in (2, 3) for r in out)
    eight = [r for r in out if r.doc_id == 8]
    assert len(eight) == 2 and sum(r.kept for r in eight) == 1 and eight[0].group_size == 2
    ones = [r for r in out if r.doc_id in (5, 6)]
    assert [(r.doc_id, r.kept) for r in sorted(ones, key=lambda r: r.doc_id)] == [(5, True), (6, False)]
    clean = line_dedup.dedup_lines(df)
    assert clean.count() == 14 and clean.filter("text is null").count() == 1
    assert line_dedup.digest(spark.createDataFrame([], SCHEMA)).collect() == []
    clash = line_dedup.dedup_lines(df.withColumn("_gone", F.lit(1)))
    assert clash.columns == [*df.columns, "_gone"] and clash.filter("_gone = 1").count() == 14
