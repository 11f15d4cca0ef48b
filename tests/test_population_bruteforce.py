"""Population objects from a JSON document against the API client's rules in Python."""

import json
import os

from hypothesis import HealthCheck, given, settings, strategies as st

from tallyhouse.plans import staging as S
from tallyhouse.session import fresh_scratch_path
from tallyhouse.sources import files

CODES = ["AAA", "BBB", "CCC", "", None, 0, False, 123, True, []]
NAMES = ["a", "b", "", None, 0, True]
POPULATIONS = [40218234, "12", 12.9, True, False, "12.9", None, 0, -5, "0", " 12", "+5",
               "12.0", 1.0, 2500.0, [], {}, "abc", -0.5, 7, "7 "]

obj = st.fixed_dictionaries({}, optional={
    "alpha3Code": st.sampled_from(CODES), "name": st.sampled_from(NAMES),
    "population": st.sampled_from(POPULATIONS)})


def python_client(items):
    rows = {}
    for item in items:
        code, name, pop = item.get("alpha3Code"), item.get("name"), item.get("population")
        if not code or not name or pop is None:
            continue
        try:
            value = int(pop)
        except Exception:  # noqa: BLE001
            continue
        if value <= 0:
            continue
        rows[str(code)] = (str(name), value)      # later objects overwrite earlier ones
    return rows


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(items=st.lists(obj, max_size=30))
def test_population_equals_client_rules(spark, items):
    d = fresh_scratch_path(spark, "popjson")
    os.makedirs(d)
    with open(os.path.join(d, "p.json"), "w") as f:
        json.dump(items, f)
    got = {r.iso_code: (r.country, r.population)
           for r in S.validate_population(files.read_population_json(spark, d)).collect()}
    assert got == python_client(items)


def test_every_population_spelling(spark):
    items = [{"alpha3Code": f"C{i:02d}", "name": "n", "population": p}
             for i, p in enumerate(POPULATIONS)]
    items += [{"alpha3Code": c, "name": "n", "population": 5} for c in CODES]
    items += [{"alpha3Code": "NAM", "name": n, "population": 5} for n in NAMES]
    d = fresh_scratch_path(spark, "popjson")
    os.makedirs(d)
    with open(os.path.join(d, "p.json"), "w") as f:
        json.dump(items, f)
    got = {r.iso_code: (r.country, r.population)
           for r in S.validate_population(files.read_population_json(spark, d)).collect()}
    assert got == python_client(items)
