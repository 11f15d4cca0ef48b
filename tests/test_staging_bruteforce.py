"""Staging against a plain-Python implementation of its rules on random raw rows."""

import re
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings, strategies as st

from tallyhouse.plans import staging as S
from tests.helpers import raw_rates

YEARS = ["1991", "2025", "1990", "2026", "19x5", "2020\n", " 2020", "2000", "2001", "", None]
VALUES = ["0", "100", "100.0004", "100.0005", "12.5", "-1", "+5", ".5", "5.", "1e3", " 5", "",
          None, "99999999", "3.14159", "0.0005", "0.0004", "007.5", "55.5555"]
SEXES = ["Male", "Female", "Total", "male", "TOTAL", None]
AGES = ["15+", "15-24", "25+", "65+", None]

row = st.tuples(st.sampled_from(["AAA", "BBB", "CCC"]), st.sampled_from(["x", "y", "z"]),
                st.sampled_from(SEXES), st.sampled_from(AGES), st.sampled_from(YEARS),
                st.one_of(st.sampled_from(VALUES),
                          st.decimals(min_value=0, max_value=120, places=4).map(str)))


def python_staging(rows):
    out = {}
    for iso, country, sex, age, year, value in rows:
        if year is None or not re.fullmatch(r"[0-9]{4}", year) or not 1991 <= int(year) <= 2025:
            continue
        if sex not in ("Male", "Female", "Total") or age not in ("15+", "15-24", "25+"):
            continue
        if value is None or not re.fullmatch(r"([0-9]+)(\.[0-9]+)?", value):
            continue
        rate = Decimal(value).quantize(Decimal("0.001"), rounding=ROUND_HALF_UP)
        if rate >= Decimal("10000000") or not Decimal(0) <= rate <= Decimal(100):
            continue
        out.setdefault((iso, sex, age, int(year)), (country, rate))
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, max_size=80))
def test_staging_equals_python_rules(spark, rows):
    staged = S.stage_rates(raw_rates(spark, rows), "employment_rate").collect()
    got = {(r.iso_code, r.sex, r.age, r.year): (r.country, r.employment_rate) for r in staged}
    assert got == python_staging(rows)
