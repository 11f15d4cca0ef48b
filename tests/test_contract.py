"""Driver contract guards: stable entry schema, limits only where they are the feature."""

import re

import __spark_entry__ as E

TOP_K_QUERIES = {"q03", "q06", "q09", "q10", "q11", "q14", "q16", "q17", "wide_top_gap"}


def test_entry_schema_is_stable(spark):
    first = E.entry(spark).schema
    second = E.entry(spark).schema
    assert first == second
    assert [f.name for f in first] == [
        "iso_code", "country", "year", "employment_rate_15plus_total",
        "unemployment_rate_15plus_total", "unemployment_to_employment_ratio",
        "unemployment_minus_employment"]


def test_limits_only_in_top_k_reports():
    sql = {k: v for k, v in E.oracle_sql().items() if k in E.warehouse_queries()}
    with_limit = {k for k, v in sql.items() if re.search(r"\bLIMIT\b", v, re.IGNORECASE)}
    assert with_limit == TOP_K_QUERIES
    assert set(E.warehouse_queries()) == set(sql)


def _sources():
    import pathlib
    root = pathlib.Path(__file__).resolve().parent.parent / "tallyhouse"
    return {str(p.relative_to(root)): p.read_text() for p in root.rglob("*.py") if p.parent.name != "llm"}


def test_spark_code_limits_only_in_top_k():
    assert {k for k, v in _sources().items() if ".limit(" in v} == {"plans/queries.py"}


def test_no_caps_or_size_switches():
    for name, text in _sources().items():
        assert ".show(" not in text or name == "__main__.py" and text.count(".show(") == 1, name
        # the data contract's value ranges are the only maxima
        found = set(re.findall(r"\b[A-Z_]*(?:MAX_|_MAX|_LIMIT|LIMIT_)[A-Z_]*\b", re.sub(r"(?m)#.*$", "", text)))
        assert found <= {"YEAR_MAX", "RATE_MAX"}, (name, found)
        assert not re.search(r"lpad\([^)]*_f", text), name
        assert ".repartition(" not in text and 'hint("merge")' not in text, name
