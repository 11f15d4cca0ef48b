import hashlib
import re

import duckdb
from pyspark.sql import functions as F

from tallyhouse.llm import exact_dedup
from tests.llm.docs import SCHEMA, awkward, random_docs


def brute(rows):
    groups = {}
    for d, t, *_ in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((d, t or ""))
    out = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        for d, _ in members:
            out.append((d, keep, len(members), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df, **k):
    rows = exact_dedup.exact_duplicates(df, **k).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.text_sha256, []).append(r)
    assert all(sum(r.kept for r in g) == 1 and all(r.doc_id == r.keep_id for r in g if r.kept)
               for g in groups.values())
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=str)


def copies():
    rows = random_docs(200, 4)
    return rows + [(1000 + i, rows[i % 7][1].replace(" ", "  "), "en", "z") for i in range(60)] + [
        (2000, rows[0][1] + rows[1][1], "en", "z"), (2001, rows[0][1] + rows[1][1][:-1] + "q", "en", "z")]


def test_awkward_rows(spark):
    from tests.llm.docs import AWKWARD
    assert got(awkward(spark, extra="name hash blocks")) == brute(AWKWARD)
    assert got(spark.createDataFrame([], SCHEMA)) == []


def test_many_levels(spark):
    df = spark.createDataFrame(copies(), SCHEMA).repartition(4)
    assert got(df, block=7) == brute(copies())


def test_hash_collisions_do_not_matter(spark):
    df = spark.createDataFrame(copies(), SCHEMA).repartition(4)
    assert got(df, block=16, hasher=lambda c: F.pmod(F.xxhash64(c), F.lit(50))) == brute(copies())


def test_sql(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}')")
    want = con.execute(exact_dedup.SQL)
    names = [d[0] for d in want.description]
    df = exact_dedup.digest(spark.read.parquet(path))
    assert sorted(map(str, df.select(*names).collect())) == sorted(
        "Row(" + ", ".join(f"{n}={v!r}" for n, v in zip(names, r)) + ")" for r in want.fetchall())
