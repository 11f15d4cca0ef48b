"""CSV and JSON sources: parsing rules, positions, failures."""

import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from tallyhouse.plans import staging as S
from tallyhouse.session import fresh_scratch_path
from tallyhouse.sources import files

HEADER = "iso_code,country,sex,age,year,obs_value\n"


def _write(spark, name, text):
    d = fresh_scratch_path(spark, "src")
    os.makedirs(d)
    p = os.path.join(d, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_csv_quoting_and_nulls(spark):
    p = _write(spark, "a.csv", HEADER
               + 'AAA,"x, y",Male,15+,2000,1.5\n'
               + 'BBB,"a""b",Male,15+,2000,""\n'
               + 'CCC,"multi\nline",Total,15+,2001,\n')
    rows = files.read_rate_csv(spark, p, multi_line=True).orderBy("_pos").collect()
    assert [r.country for r in rows] == ["x, y", 'a"b', "multi\nline"]
    assert rows[1].obs_value == "" and rows[2].obs_value is None
    assert [r._pos.seq for r in rows] == sorted(r._pos.seq for r in rows)


@pytest.mark.parametrize("line", ["AAA,A,Male\n", "AAA,A,Male,15+,2000,1,extra\n"])
def test_csv_wrong_field_count_fails(spark, line):
    p = _write(spark, "bad.csv", HEADER + "AAA,A,Male,15+,2000,1\n" + line)
    for multi_line in (False, True):
        df = files.read_rate_csv(spark, p, multi_line)
        for action in (df.collect, df.count, df.select("iso_code").collect):
            with pytest.raises((PySparkException, Py4JJavaError)):
                action()


def test_csv_line_break_in_a_field_fails_in_split_mode(spark):
    p = _write(spark, "breaks.csv", HEADER + 'AAA,"A\nTotal",Male,15+,2000,1\n')
    assert [r.country for r in files.read_rate_csv(spark, p, multi_line=True).select("country").collect()] == ["A\nTotal"]
    df = files.read_rate_csv(spark, p)
    for action in (df.collect, df.count, df.select("country").collect):
        with pytest.raises((PySparkException, Py4JJavaError)):
            action()


def test_csv_missing_file_fails(spark):
    with pytest.raises(PySparkException):
        files.read_rate_csv(spark, "/nonexistent/dir/x.csv").collect()


def test_csv_file_order_decides_keep_first(spark):
    d = fresh_scratch_path(spark, "src")
    os.makedirs(d)
    body = "".join(f"AAA,C{i},Total,15+,2000,{i}\n" for i in range(1, 2000))
    with open(os.path.join(d, "part-0.csv"), "w") as f:
        f.write(HEADER + body)
    with open(os.path.join(d, "part-1.csv"), "w") as f:
        f.write(HEADER + "AAA,Z,Total,15+,2000,0\n")
    raw = files.read_rate_csv(spark, d)
    out = S.stage_rates(raw, "employment_rate").collect()
    assert len(out) == 1 and out[0].country == "C1"


def _json(spark, text):
    return _write(spark, "p.json", text)


def test_json_population_coercion(spark):
    p = _json(spark, """[
      {"alpha3Code": "AAA", "name": "a", "population": 40218234},
      {"alpha3Code": "BBB", "name": "b", "population": "12"},
      {"alpha3Code": "CCC", "name": "c", "population": 12.9},
      {"alpha3Code": "DDD", "name": "d", "population": true},
      {"alpha3Code": "EEE", "name": "e", "population": "12.9"},
      {"alpha3Code": "FFF", "name": "f", "population": null},
      {"alpha3Code": "GGG", "name": "g", "population": 0},
      {"alpha3Code": "HHH", "name": "h", "population": -5},
      {"alpha3Code": "III", "name": "i"},
      {"alpha3Code": "", "name": "j", "population": 5},
      {"alpha3Code": "KKK", "name": "", "population": 5},
      {"alpha3Code": "AAA", "name": "a2", "population": 7}
    ]""")
    objs = files.read_population_json(spark, p)
    got = {r.iso_code: (r.country, r.population) for r in S.validate_population(objs).collect()}
    assert got == {"AAA": ("a2", 7), "BBB": ("b", 12), "CCC": ("c", 12), "DDD": ("d", 1)}


def test_json_falsy_code_or_name_skipped(spark):
    p = _json(spark, """[
      {"alpha3Code": 0, "name": "zero", "population": 5},
      {"alpha3Code": false, "name": "f", "population": 5},
      {"alpha3Code": null, "name": "n", "population": 5},
      {"alpha3Code": [], "name": "a", "population": 5},
      {"alpha3Code": "AAA", "name": 0, "population": 5},
      {"alpha3Code": "BBB", "name": {}, "population": 5},
      {"alpha3Code": 123, "name": true, "population": 5},
      {"alpha3Code": "CCC", "name": "c", "population": 5}
    ]""")
    got = {r.iso_code: r.country for r in
           S.validate_population(files.read_population_json(spark, p)).collect()}
    assert got == {"123": "True", "CCC": "c"}


def test_json_top_level_object_fails(spark):
    p = _json(spark, '{"alpha3Code": "AAA", "name": "a", "population": 1}')
    with pytest.raises((PySparkException, Py4JJavaError)):
        files.read_population_json(spark, p).collect()


def test_json_round_trip_keeps_order(spark, tmp_path):
    from tallyhouse.sources import testfeeds
    from tests.conftest import SMALL
    objs = testfeeds.population_objects(spark, SMALL)
    path = fresh_scratch_path(spark, "popjson")
    files.write_population_json(objs, path, rows_per_file=40)
    back = files.read_population_json(spark, path)
    a = S.validate_population(objs).orderBy("iso_code").collect()
    b = S.validate_population(back).orderBy("iso_code").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]


def test_split_csv_file_keeps_file_order(spark):
    """One file read in many byte-range splits: (file, block, seq) is still file order."""
    from tallyhouse.plans.layers import layers_from_tables
    from tests.conftest import SMALL
    from tallyhouse.sources import testfeeds
    path = fresh_scratch_path(spark, "split-csv")
    feed = testfeeds.employment_feed(spark, SMALL).orderBy("_pos").coalesce(1)
    files.write_rate_csv(feed, path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        raw = files.read_rate_csv(spark, path, multi_line=False)
        assert raw.rdd.getNumPartitions() > 5
        got = sorted(tuple(r) for r in S.stage_rates(raw, "employment_rate").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    expected = sorted(tuple(r) for r in layers_from_tables(spark, SMALL).stg_employment.collect())
    assert got == expected
