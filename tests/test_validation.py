"""Staging rules on hand-written edge rows."""

from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from tallyhouse.plans import staging as S
from tests.helpers import raw_rates


def staged(spark, rows, strict=False):
    raw = raw_rates(spark, rows)
    return S.stage_rates(raw, "employment_rate", strict=strict)


def one_rate(spark, value, strict=False):
    out = staged(spark, [("AAA", "A", "Total", "15+", "2000", value)], strict).collect()
    return out[0].employment_rate if out else None


@pytest.mark.parametrize("text,expected", [
    ("0", Decimal("0.000")), ("100", Decimal("100.000")), ("100.0004", Decimal("100.000")),
    ("12.5", Decimal("12.500")), ("0" * 45 + "12.5", Decimal("12.500")),
])
def test_rates_accepted(spark, text, expected):
    assert one_rate(spark, text) == expected


@pytest.mark.parametrize("text", ["100.0005", "-1", "+5", ".5", "5.", "1e3", " 5", "", None,
                                  "5 ", "1,5", "99999999"])
def test_rates_rejected(spark, text):
    assert one_rate(spark, text) is None


def test_rate_overflow_strict_raises(spark):
    with pytest.raises((PySparkException, Py4JJavaError)):
        one_rate(spark, "99999999", strict=True)


@pytest.mark.parametrize("year,ok", [("1991", True), ("2025", True), ("1990", False),
                                     ("2026", False), ("19x5", False), ("2020\n", False),
                                     (" 2020", False), ("02020", False), (None, False)])
def test_year_rule(spark, year, ok):
    out = staged(spark, [("AAA", "A", "Total", "15+", year, "5")]).collect()
    assert bool(out) == ok
    if ok:
        assert out[0].year == int(year)


@pytest.mark.parametrize("sex,age", [("male", "15+"), ("TOTAL", "15+"), ("Total", "65+"),
                                     (None, "15+"), ("Total", None)])
def test_domain_case_sensitive(spark, sex, age):
    assert staged(spark, [("AAA", "A", sex, age, "2000", "5")]).count() == 0


def test_null_key_in_valid_row_fails(spark):
    with pytest.raises((PySparkException, Py4JJavaError)):
        staged(spark, [(None, "A", "Total", "15+", "2000", "5")]).collect()


def test_null_country_in_valid_row_fails(spark):
    with pytest.raises((PySparkException, Py4JJavaError)):
        staged(spark, [("AAA", None, "Total", "15+", "2000", "5")]).collect()


def test_null_country_in_later_duplicate_fails(spark):
    rows = [("AAA", "first", "Total", "15+", "2000", "5"),
            ("AAA", None, "Total", "15+", "2000", "6")]
    with pytest.raises((PySparkException, Py4JJavaError)):
        staged(spark, rows).collect()


def test_null_key_in_invalid_row_is_just_rejected(spark):
    assert staged(spark, [(None, "A", "Total", "15+", "1800", "5")]).count() == 0


def test_first_valid_row_kept_whole(spark):
    rows = [
        ("AAA", "Bad first", "Total", "15+", "2000", "n/a"),   # invalid: does not count
        ("AAA", "First", "Total", "15+", "2000", "10.5"),
        ("AAA", "Second", "Total", "15+", "2000", "20.5"),
        ("BBB", "B", "Total", "15+", "2000", "1"),
    ]
    out = {r.iso_code: r for r in staged(spark, rows).collect()}
    assert out["AAA"].country == "First" and out["AAA"].employment_rate == Decimal("10.500")
    assert out["BBB"].employment_rate == Decimal("1.000")
