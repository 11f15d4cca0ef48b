"""Audit classification over random delivery histories against the rules in Python."""

import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st

from tallyhouse.operators import audit as A


def python_audit(history):
    out, prev = [], {}
    for source, rows, fp in history:
        if source not in prev:
            out.append((source, rows, fp, None, None, None, rows, 0, "first_load"))
        else:
            p_rows, p_fp = prev[source]
            delta = rows - p_rows
            kind = ("row_count_changed" if delta != 0 else
                    "content_changed_same_count" if fp != p_fp else "unchanged")
            out.append((source, rows, fp, p_rows, p_fp, delta, max(delta, 0), max(-delta, 0), kind))
        prev[source] = (rows, fp)
    return out


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(runs=st.lists(st.dictionaries(st.sampled_from(["s1", "s2", "s3"]),
                                     st.tuples(st.integers(0, 3), st.integers(0, 2)),
                                     min_size=1), min_size=1, max_size=3))
def test_classify_equals_rules(spark, runs):
    history = A.empty_history(spark)
    expected_flat = []
    seen = []
    t0 = dt.datetime(2025, 1, 1)
    for i, run in enumerate(runs):
        new = A.classify(A.observed_snapshot(spark, run), history, t0 + dt.timedelta(days=i))
        history = history.unionByName(new).checkpoint()
        seen += [(s, r, f) for s, (r, f) in sorted(run.items())]
    def key(t):
        return tuple(-1 if v is None else v for v in t)
    expected_flat = sorted(python_audit(seen), key=key)
    got = sorted((tuple(r)[:-1] for r in history.collect()), key=key)
    assert got == expected_flat
