"""CSV files with line breaks inside fields, split; strict bytes."""

import csv
import io
import os
import random

import pytest

from tallyhouse.session import fresh_scratch_path
from tallyhouse.sources import files
from tallyhouse.sources.quoted_csv import csv_defects, csv_records, read_quoted_csv

HEADER = "iso_code,country,sex,age,year,obs_value\n"
SIX = ["iso_code", "country", "sex", "age", "year", "obs_value"]


def land(spark, *texts):
    folder = fresh_scratch_path(spark, "quoted")
    os.makedirs(folder)
    for i, t in enumerate(texts):
        with open(f"{folder}/f{i}.csv", "wb") as f:
            f.write(t if isinstance(t, bytes) else t.encode())
    return folder


@pytest.fixture
def small_blocks(spark):
    """Splits of about 300 bytes, so that small files are many tasks."""
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def random_file(seed, rows=60, end="\n"):
    r = random.Random(seed)
    pieces = ["a", "b c", ",", '""', "\n", "\r\n", "\n\n", "é", "日本", "x" * 40, "\n" * 9, "y" * 700]
    out = []
    for i in range(rows):
        quoted = ['"' + "".join(r.choice(pieces) for _ in range(r.randint(0, 6))) + '"' for _ in range(2)]
        plain = [r.choice(["", "Male", "15+", "2001"]) for _ in range(3)]
        out.append(",".join([f"K{i}", quoted[0], *plain, quoted[1] if r.random() < 0.4 else str(i)]))
    return HEADER.replace("\n", end) + end.join(out) + r.choice(["", end])


def expect(text):
    """Python's own csv module; it does not tell an empty field from a quoted empty one."""
    rows = list(csv.reader(io.StringIO(text, newline=""), strict=True))
    return [tuple(x) for x in rows[1:]]


def rows_of(df):
    return [tuple("" if v is None else v for v in r[:6]) for r in df.orderBy("_pos").collect()]


@pytest.mark.parametrize("seed", range(2))
def test_any_split_gives_the_records(spark, small_blocks, seed):
    texts = [random_file(10 * seed + i, end=e) for i, e in enumerate(["\n", "\r\n"])]
    folder = land(spark, *texts)
    df = read_quoted_csv(spark, folder)
    assert rows_of(df) == expect(texts[0]) + expect(texts[1])
    blocks = csv_records(spark, folder).select("file", "block").distinct().groupBy("file").count().collect()
    assert all(b["count"] > 5 for b in blocks) and len(blocks) == 2


def test_equals_multi_line_reader(spark, small_blocks):
    folder = land(spark, random_file(77), HEADER, HEADER + 'A,"",m,a,,\n')
    got = read_quoted_csv(spark, folder).orderBy("_pos").select(*SIX).collect()
    assert got == files.read_rate_csv(spark, folder, multi_line=True).orderBy("_pos").select(*SIX).collect()
    assert got[-1].country == "" and got[-1].year is None


def test_one_record_over_many_blocks(spark, small_blocks):
    long = "line of a long field\n" * 200
    folder = land(spark, HEADER + f'A,"{long}",m,a,2000,1\nB,b,m,a,2000,2\n')
    assert rows_of(read_quoted_csv(spark, folder)) == [("A", long, "m", "a", "2000", "1"), ("B", "b", "m", "a", "2000", "2")]


@pytest.mark.parametrize("body, message", [
    ("A,a,m,a,2000,1\n\nB,b,m,a,2000,1\n", "blank line"),
    ("A,a,m,a,2000,1\r\n\r\nB,b,m,a,2000,1\r\n", "blank line"),
    ('A,"a\n",m,a,2000,1\n\n', "blank line"),
    (b"A,a\xff,m,a,2000,1\n", "not UTF-8"),
    (b"A,\xc3,m,a,2000,1\n", "not UTF-8"),
    ("A,a\0,m,a,2000,1\n", "not UTF-8"),
    ('A,"a,m,a,2000,1\nB,b,m,a,2000,1\n', "not closed"),
    ("A,a,m,a,2000\n", ""),
    ("A,a,m,a,2000,1,2\n", ""),
])
def test_bad_files_fail_the_run(spark, body, message):
    body = body if isinstance(body, bytes) else body.encode()
    folder = land(spark, HEADER.encode() + b"Z,z,m,a,2000,1\n" + body)
    for action in ("collect", "count"):
        with pytest.raises(Exception, match=message):
            getattr(read_quoted_csv(spark, folder).select("iso_code"), action)()


def test_blank_lines_inside_a_field_are_content(spark):
    folder = land(spark, HEADER + 'A,"a\n\n\nb",m,a,2000,1\n')
    assert rows_of(read_quoted_csv(spark, folder))[0][1] == "a\n\n\nb"


def test_defects_are_counted(spark, small_blocks):
    folder = land(spark, HEADER.encode() + b'A,"x\n\ny",m,a,1,1\n\n' + b'B,"\xc3",m,a,1,1\n' * 3 + b"\r\n",
                  HEADER + 'A,"open,m,a,1,1\n' * 3)
    rows = {os.path.basename(r.file): r for r in csv_defects(spark, folder).collect()}
    a, b = rows["f0.csv"], rows["f1.csv"]
    assert (a.lines, a.records, a.blank_records, a.invalid_lines, a.unclosed) == (9, 7, 2, 3, False)
    assert (b.lines, b.records, b.unclosed) == (4, 3, True)


def test_refresh_fails_and_publishes_nothing(spark):
    from tallyhouse.plans import refresh as R
    good = land(spark, HEADER + "AAA,a,Total,15+,2000,1\n")
    bad = land(spark, HEADER + "AAA,a,Total,15+,2000,1\n\n")
    people = land(spark, '[{"alpha3Code": "AAA", "name": "a", "population": 5}]')
    root = fresh_scratch_path(spark, "strict-warehouse")
    with pytest.raises(Exception, match="blank line"):
        R.run_refresh(spark, R.feeds_from_files(spark, good, bad, people), root)
    with pytest.raises(RuntimeError, match="no published run"):
        R.published_marts(spark, root)
    R.run_refresh(spark, R.feeds_from_files(spark, good, good, people), root)
    assert R.published_marts(spark, root).fact.count() == 1
