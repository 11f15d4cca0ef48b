"""Copy-on-write merges by partition, and keep-first over deliveries."""

import glob
import random

import pytest

from tallyhouse.operators.upsert import insert_ignore, upsert
from tallyhouse.session import fresh_scratch_path
from tallyhouse.sources.commits import CommitConflict
from tallyhouse.sources.partitioned import PartitionedTable

ROWS = "iso_code string, year int, rate long, country string"
KEYS = ["iso_code", "year"]


def frame(spark, rows, schema=ROWS):
    return spark.createDataFrame(rows, schema)


def values(df):
    return sorted(map(str, map(tuple, df.collect())))


def random_rows(r, years, n):
    keys = {(r.choice("ABCDEFGH"), r.choice(years)) for _ in range(n)}
    return [(k, y, r.randrange(100), f"c{r.randrange(9)}") for k, y in sorted(keys)]


@pytest.fixture
def table(spark):
    t = PartitionedTable(spark, fresh_scratch_path(spark, "cow"), frame(spark, []).schema)
    t.upsert(frame(spark, random_rows(random.Random(1), range(2000, 2010), 60)), KEYS, ["rate"])
    return t


def damage(table, year):
    for f in glob.glob(f"{table.folder}/{table.parts()[str(year)]}/*.parquet"):
        with open(f, "wb") as out:
            out.write(b"not parquet")


def test_merge_equals_the_join_of_whole_tables(spark, table):
    r = random.Random(7)
    for years in ([2001], [2003, 2004], range(2008, 2014)):
        source, before = frame(spark, random_rows(r, list(years), 12)), table.read()
        want = values(upsert(before, source, KEYS, ["rate"]))
        table.upsert(source, KEYS, ["rate"])
        assert values(table.read()) == want
        more = frame(spark, [(*x, i) for i, x in enumerate(random_rows(r, list(years), 12) * 2)], ROWS + ", pos long")
        want = values(insert_ignore(table.read(), more, KEYS, ["pos"]))
        table.insert_ignore(more, KEYS, ["pos"])
        assert values(table.read()) == want
    assert table.version() == 7


def test_untouched_partitions_are_not_read(spark, table):
    before = table.parts()
    for year in before:
        if year != "2004":
            damage(table, year)        # whoever reads it fails
    table.upsert(frame(spark, [("Z", 2004, 5, "new"), ("A", 2004, 6, "new")]), KEYS, ["rate"])
    after = table.parts()
    assert {y for y in before if before[y] != after[y]} == {"2004"} and set(after) == set(before)
    assert table.read(values=[2004]).filter("iso_code = 'Z'").count() == 1
    touched = table.read(values=[2004]).inputFiles()
    assert touched and all("p=2004" in f for f in touched)
    with pytest.raises(Exception):
        table.read().collect()


def test_overlapping_merges(spark, table):
    def slow(target, source):
        table.upsert(frame(spark, [("Q", 2001, 1, "quick")]), KEYS, ["rate"])
        return upsert(target, source, KEYS, ["rate"])

    folders = set(glob.glob(f"{table.folder}/data-*"))
    with pytest.raises(CommitConflict):
        table.merge(frame(spark, [("S", 2001, 2, "slow")]), slow)
    assert {r.iso_code for r in table.read().collect()} >= {"Q"}
    assert table.read().filter("iso_code = 'S'").count() == 0
    assert len(set(glob.glob(f"{table.folder}/data-*")) - folders) == 1     # the loser's files are gone


def test_versions_can_be_pinned_and_freed(spark, table):
    first = values(table.read())
    table.upsert(frame(spark, [("A", 2000, 1, "x")]), KEYS, ["rate", "country"])
    assert values(table.read(version=1)) == first != values(table.read())
    assert len(table.vacuum(keep=2)) == 0 and len(table.vacuum()) == 1
    assert table.read().filter("country = 'x'").count() == 1
    assert table.upsert(frame(spark, []), KEYS, ["rate"]) == table.version() == 2     # nothing to merge
    with pytest.raises(ValueError):
        table.upsert(frame(spark, []), ["iso_code"], ["rate"])


def test_deliveries_in_any_order_equal_one_pass(spark):
    r = random.Random(3)
    rows = [(r.choice("ABC"), r.randrange(2000, 2004), r.randrange(9), "c", i % 4, i) for i in range(200)]
    schema = ROWS + ", delivery int, pos int"
    want = {}
    for row in sorted(rows, key=lambda x: (x[4], x[5])):
        want.setdefault(row[:2], row)
    for order in ([0, 1, 2, 3], [3, 1, 0, 2, 1]):
        t = PartitionedTable(spark, fresh_scratch_path(spark, "winners"), frame(spark, [], schema).schema)
        for d in order:
            t.keep_first(frame(spark, [x for x in rows if x[4] == d], schema), KEYS, ["delivery", "pos"])
        assert values(t.read()) == sorted(map(str, want.values()))
