"""Published marts as SQL views; the command line."""

import datetime as dt

from tallyhouse.__main__ import main
from tallyhouse.plans import queries as Q
from tallyhouse.plans import refresh as R
from tallyhouse.plans.catalog import register_views
from tallyhouse.plans.layers import feeds_from_tables
from tallyhouse.session import fresh_scratch_path
from tests.conftest import SMALL


def test_sql_views_answer_like_the_catalogue(spark):
    root = fresh_scratch_path(spark, "wh")
    R.run_refresh(spark, feeds_from_tables(spark, SMALL), root, dt.datetime(2025, 5, 1))
    register_views(spark, root)
    api = R.published_marts(spark, root)
    total, fact = "mart.country_year_total_15plus", "mart.country_year_sex_age_rates"
    statements = {
        "q03": f"""SELECT iso_code, country, year, employment_rate_15plus_total, unemployment_rate_15plus_total,
                     unemployment_to_employment_ratio, unemployment_minus_employment FROM {total}
                   WHERE year = (SELECT max(year) FROM {total})
                   ORDER BY unemployment_to_employment_ratio DESC NULLS FIRST, iso_code LIMIT 10""",
        "q02": f"SELECT year, count(*) AS rows_in_fact FROM {fact} GROUP BY year ORDER BY year",
        "q07": f"""SELECT year, count(DISTINCT iso_code) AS distinct_countries FROM {fact}
                   WHERE year = (SELECT max(year) FROM {fact}) GROUP BY year""",
        "q13": f"""SELECT year, sex, age, count(*) AS rows FROM {fact}
                   WHERE year = (SELECT max(year) FROM {fact}) GROUP BY year, sex, age ORDER BY sex, age""",
        "q18": """SELECT year, sum(unemployment_persons_est) AS total_unemployed_persons_est
                  FROM mart.country_year_total_15plus_with_population GROUP BY year ORDER BY year"""}
    for name, sql in statements.items():
        assert [tuple(r) for r in spark.sql(sql).collect()] == [tuple(r) for r in Q.CATALOGUE[name](api).collect()], name
    counts = spark.sql("SELECT (SELECT count(*) FROM mart.country_population) AS a, "
                       "(SELECT count(*) FROM mart.etl_source_audit) AS b").first()
    assert (counts.a, counts.b) == (24, 3)


def test_cli_query(spark, capsys):
    root = fresh_scratch_path(spark, "wh")
    R.run_refresh(spark, feeds_from_tables(spark, SMALL), root, dt.datetime(2025, 5, 1))
    assert main(["query", "--warehouse", root, "q15"]) == 0
    assert "country_population_rows" in capsys.readouterr().out
    assert main(["query", "--warehouse", root,
                 "SELECT count(*) AS n FROM mart.country_year_sex_age_rates"]) == 0
    assert "580" in capsys.readouterr().out


def test_cli_prints_every_row_or_writes(spark, capsys):
    root, out = fresh_scratch_path(spark, "wh"), fresh_scratch_path(spark, "out")
    R.run_refresh(spark, feeds_from_tables(spark, SMALL), root, dt.datetime(2025, 5, 1))
    sql = "SELECT * FROM ingestion.unemployment_raw"
    assert main(["query", "--warehouse", root, sql]) == 0
    assert capsys.readouterr().out.count("\n") >= 6001
    assert main(["query", "--warehouse", root, "--output", out, sql]) == 0
    assert spark.read.json(out).count() == 6000
