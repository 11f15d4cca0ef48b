"""Every registered query against its DuckDB oracle on the smallest test tables."""


import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def v(x):
        return "NULL" if x is None else (repr(x) if isinstance(x, float) else str(x))
    return sorted("|".join(v(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(E.warehouse_queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.warehouse_queries()[name](spark, SMALL)
    srows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    assert sql is not None, f"{name} has no oracle"
    rel = con.execute(sql)
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert canon(srows, df.columns) == canon(orows, ocols)


def test_entry_runs(spark):
    out = E.entry(spark).collect()
    assert 0 < len(out) <= 10
