"""JSON lists split into blocks, and fingerprints folded from files."""

import json
import os
import random

import pytest

from tallyhouse.functions.fingerprint import fingerprint_agg
from tallyhouse.plans import refresh as R
from tallyhouse.session import fresh_scratch_path
from tallyhouse.sources import files
from tallyhouse.sources.file_fingerprints import FileFingerprints
from tallyhouse.sources.split_json import list_elements, read_split_json
from tests.test_quoted_csv import HEADER, SIX, land, small_blocks  # noqa: F401


def random_value(r, deep=0):
    k = r.randrange(9 if deep < 3 else 6)
    if k < 3:
        return "".join(r.choice(['"', "\\", "}", "{", "]", "[", ",", "\n", "é", "日", "a b", "\\\\", "\\\""]) for _ in range(r.randrange(9)))
    if k < 6:
        return [r.randrange(-99, 10 ** 6), None, True, False, 1.5][r.randrange(5)]
    if k < 7:
        return [random_value(r, deep + 1) for _ in range(r.randrange(4))]
    return {f"k{i}{r.choice(['', '}', '{', chr(34)])}": random_value(r, deep + 1) for i in range(r.randrange(4))}


def elements(spark, folder):
    rows = list_elements(spark, folder).orderBy("_pos").selectExpr("to_json(item) j", "_pos.file f").collect()
    out = {}
    for x in rows:
        out.setdefault(os.path.basename(x.f), []).append(json.loads(x.j))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_any_split_gives_the_elements(spark, small_blocks, seed):  # noqa: F811
    r = random.Random(seed)
    docs = [[random_value(r) for _ in range(60)], [], [1, "a", None], [[{"a": 1}], {"b": "}"}, [[]], {}], ["[{]}" * 200]]
    folder = land(spark, *[json.dumps(d, ensure_ascii=r.random() < 0.5, indent=r.choice([None, 1])) for d in docs])
    got = elements(spark, folder)
    assert [got.get(f"f{i}.csv", []) for i in range(len(docs))] == docs
    blocks = list_elements(spark, f"{folder}/f0.csv").select("_pos.block").distinct().count()
    assert blocks > 3


def test_same_rows_as_the_whole_reader(spark, small_blocks):  # noqa: F811
    objects = [{"alpha3Code": f"A{i}", "name": ["x", "", None, "q\"}"][i % 4], "population": [5, "7", 12.9, True, "n", None][i % 6]}
               for i in range(80)]
    folder = land(spark, json.dumps(objects), "[]", " [ ] ", '[3, {"alpha3Code": "Z", "name": "z", "population": 1}]\n')
    rows = [[tuple(x)[:3] for x in f(spark, folder).orderBy("_pos").collect()] for f in (read_split_json, files.read_population_json)]
    assert rows[0] == rows[1] and len(rows[0]) == 82


@pytest.mark.parametrize("text", ['{"a": 1}', '{"a": [{"b": 1}]}', "3", '"x"', '[{"a": 1}', '[{"a": 1}]]', '[{"a": 1}] [2]',
                                  '[{"a": 1} {"b": 2}]', '[{"a": 1},]', '[{"a": 1},,{"b": 2}]', '[{"a": }]', '[{"a": "x}]'])
def test_bad_documents_fail(spark, text):
    folder = land(spark, text)
    for columns in (["*"], ["code"]):
        with pytest.raises(Exception):
            read_split_json(spark, folder).select(*columns).collect()


def test_files_seen_before_are_not_read(spark):
    a, b = "".join(f"A{i},x,m,a,2000,{i}\n" for i in range(50)), "B,y,m,a,2000,1\n"
    folder = land(spark, HEADER + a, HEADER + b, HEADER)
    partials = FileFingerprints(spark, fresh_scratch_path(spark, "partials"), SIX)

    def full():
        return tuple(files.read_rate_csv(spark, folder).agg({"*": "count"}).first()) + tuple(
            files.read_rate_csv(spark, folder).agg(fingerprint_agg(*SIX)).first())

    read = []

    def reader(s, names):
        read.append(sorted(os.path.basename(n) for n in names))
        return files.read_rate_csv(s, names)

    look = lambda: tuple(partials.snapshot("s", reader, folder).first())[1:]
    assert look() == full() and look() == full()
    first = f"{folder}/f0.csv"
    before, was = os.stat(first), full()
    with open(first, "r+b") as f:       # same size and time: if it were read, the result would differ
        f.write(b"\0" * 200)
    os.utime(first, ns=(before.st_atime_ns, before.st_mtime_ns))
    assert look() == was
    with open(first, "wb") as f:
        f.write((HEADER + a).encode())
    os.utime(first, ns=(before.st_atime_ns, before.st_mtime_ns))
    with open(f"{folder}/f3 new%.csv", "w") as f:
        f.write(HEADER + "C,z,m,a,2000,5\n")
    with open(f"{folder}/f1.csv", "a") as f:
        f.write(b)
    assert look() == full()
    assert read == [["f0.csv", "f1.csv", "f2.csv"], ["f1.csv", "f3 new%.csv"]]
    assert partials.known().count() == 5


def test_changed_files_are_seen_before_a_refresh(spark):
    good = land(spark, HEADER + "AAA,a,Total,15+,2000,1\n")
    other = land(spark, HEADER + "AAA,a,Total,15+,2000,2\n")
    people = land(spark, '[{"alpha3Code": "AAA", "name": "a", "population": 5}]')
    root = fresh_scratch_path(spark, "wh")
    types = lambda: {r.source_name: r.change_type for r in R.changed_rate_files(spark, root, good, other).collect()}
    assert set(types().values()) == {"first_load"}
    R.run_refresh(spark, R.feeds_from_files(spark, good, other, people), root)
    assert set(types().values()) == {"unchanged"}
    with open(f"{good}/f9.csv", "w") as f:
        f.write(HEADER + "BBB,b,Total,15+,2000,1\n")
    assert types() == {R.EMPLOYMENT_SOURCE: "row_count_changed", R.UNEMPLOYMENT_SOURCE: "unchanged"}
