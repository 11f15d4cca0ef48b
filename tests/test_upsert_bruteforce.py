"""insert_ignore / upsert / upsert_ordered against dictionary semantics on random rows."""

from hypothesis import HealthCheck, given, settings, strategies as st

from tallyhouse.operators.upsert import insert_ignore, upsert, upsert_ordered

SETTINGS = settings(max_examples=10, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
keys = st.integers(0, 12)
vals = st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 99))


def frame(spark, rows, with_pos=False):
    if with_pos:
        return spark.createDataFrame([(k, c, v, i) for i, (k, (c, v)) in enumerate(rows)],
                                     "k int, c string, v int, pos int")
    return spark.createDataFrame([(k, c, v) for k, (c, v) in rows], "k int, c string, v int")


@SETTINGS
@given(target=st.dictionaries(keys, vals, max_size=10), source=st.lists(st.tuples(keys, vals), max_size=15))
def test_insert_ignore(spark, target, source):
    expected = dict(target)
    for k, cv in source:
        expected.setdefault(k, cv)
    got = insert_ignore(frame(spark, target.items()), frame(spark, source, True), ["k"], ["pos"])
    assert {r.k: (r.c, r.v) for r in got.collect()} == expected
    assert got.count() == len(expected)


@SETTINGS
@given(target=st.dictionaries(keys, vals, max_size=10), source=st.dictionaries(keys, vals, max_size=10))
def test_upsert_updates_listed_columns(spark, target, source):
    expected = dict(target)
    for k, (c, v) in source.items():
        expected[k] = (expected[k][0], v) if k in expected else (c, v)
    got = upsert(frame(spark, target.items()), frame(spark, source.items()), ["k"], ["v"])
    assert {r.k: (r.c, r.v) for r in got.collect()} == expected


@SETTINGS
@given(target=st.dictionaries(keys, vals, max_size=10), source=st.lists(st.tuples(keys, vals), max_size=15))
def test_upsert_ordered(spark, target, source):
    expected = dict(target)
    for k, cv in source:
        expected[k] = cv
    got = upsert_ordered(frame(spark, target.items()), frame(spark, source, True), ["k"], ["pos"])
    assert {r.k: (r.c, r.v) for r in got.collect()} == expected
