"""Expose the published run as SQL views, under the same table names as the marts.

After ``register_views(spark, root)`` the current run's tables are queryable with Spark
SQL as ``mart.country_year_sex_age_rates``, ``mart.country_year_total_15plus``,
``mart.country_population``, ``mart.country_year_total_15plus_with_population`` and
``mart.etl_source_audit`` (plus ``staging.*`` and ``ingestion.*``). The views read the
Parquet files of one published run directly, so Catalyst prunes partitions and pushes
filters exactly as for the DataFrame API.

Spark sorts NULLs last for DESC and first for ASC; write ``NULLS FIRST`` / ``NULLS LAST``
where the placement matters (the query catalogue in ``queries.py`` does).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallyhouse import schemas
from tallyhouse.plans import refresh as R
from tallyhouse.sources.warehouse import INGESTION, MART, STAGING, Warehouse


def _columns(df) -> str:
    return ", ".join(f"`{c}`" for c in df.columns)


def register_views(spark: SparkSession, warehouse_root: str, run_id: str | None = None) -> str:
    """Create or replace the views of one published run (default: the current one)."""
    wh = Warehouse(spark, warehouse_root)
    run_id = run_id or wh.current_run()
    for layer in (INGESTION, STAGING, MART):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    for layer, table in R.LAYER_TABLES:
        cols = _columns(wh.read(layer, table, run_id))
        path = wh.table_path(run_id, layer, table)
        spark.sql(f"CREATE OR REPLACE VIEW {layer}.{table} AS "
                  f"SELECT {cols} FROM parquet.`{path}`")
    # The audit log: one table, of which the rows of published runs up to this one show.
    cols = ", ".join(f"a.`{c}`" for c in schemas.AUDIT.fieldNames())
    spark.sql(f"""CREATE OR REPLACE VIEW {MART}.{R.AUDIT} AS
        SELECT {cols} FROM parquet.`{wh.audit_path}` a
        JOIN json.`{wh.log.folder}` m ON a.run_id = m.run_id
        WHERE m.version <= (SELECT max(version) FROM json.`{wh.log.folder}` WHERE run_id = '{run_id}')""")
    return run_id
