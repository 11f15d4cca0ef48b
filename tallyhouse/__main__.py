"""Command line: ``python -m tallyhouse run ...`` and ``python -m tallyhouse query ...``.

    run    land the rate CSV files and the population JSON, rebuild every layer, audit,
           publish; prints the run id, the row count of every table and the audit rows
    query  run a catalogue query (q01-q19) or a SQL statement on the published marts
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _session(master: str | None) -> SparkSession:
    if master:
        from tallyhouse.session import build_session
        return build_session(master=master)
    return SparkSession.builder.appName("tallyhouse").getOrCreate()


def main(argv=None) -> int:
    parser = argparse.ArgumentParser(prog="tallyhouse")
    parser.add_argument("--master", help="Spark master for a local run, e.g. local[8]")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="full refresh from landed files")
    run.add_argument("--employment", required=True, help="employment rate CSV file or folder")
    run.add_argument("--unemployment", required=True, help="unemployment rate CSV file or folder")
    run.add_argument("--population", required=True, help="population JSON file or folder")
    run.add_argument("--warehouse", required=True, help="warehouse root on shared storage")
    run.add_argument("--strict", action="store_true", help="fail on out-of-range rate values")
    run.add_argument("--lenient-csv", action="store_true",
                     help="one pass with Spark's CSV source: no line breaks inside fields, no check of bytes")
    query = sub.add_parser("query", help="query the published marts")
    query.add_argument("--warehouse", required=True)
    query.add_argument("name_or_sql", help="q01..q19, or a SQL statement over mart.* views")
    query.add_argument("--output", help="write the result as JSON lines to this path instead of printing it")
    query.add_argument("--country", default="AFG", help="country code for q04 / q12")
    args = parser.parse_args(argv)

    spark = _session(args.master)
    from tallyhouse.plans import queries as Q
    from tallyhouse.plans import refresh as R
    from tallyhouse.plans.catalog import register_views

    if args.command == "run":
        feeds = R.feeds_from_files(spark, args.employment, args.unemployment, args.population,
                                   strict_bytes=not args.lenient_csv)
        result = R.run_refresh(spark, feeds, args.warehouse, strict=args.strict)
        print(f"published run {result.run_id}")
        for table, rows in result.metrics.items():
            print(f"  {table}: {rows} rows")
        register_views(spark, args.warehouse, result.run_id)
        spark.sql("SELECT source_name, observed_rows, previous_rows, delta_rows, new_rows, "
                  "removed_rows, change_type FROM mart.etl_source_audit "
                  f"WHERE observed_at = (SELECT max(observed_at) FROM mart.etl_source_audit)"
                  ).show(truncate=False)
        return 0

    name = args.name_or_sql.strip()
    if name in Q.CATALOGUE:
        marts = R.published_marts(spark, args.warehouse)
        fn = Q.CATALOGUE[name]
        df = fn(marts, args.country) if name in Q.COUNTRY_QUERIES else fn(marts)
    else:
        register_views(spark, args.warehouse)
        df = spark.sql(name)
    if args.output:
        df.write.json(args.output)
        print(f"written to {args.output}")
        return 0
    print("\t".join(df.columns))
    for row in df.toLocalIterator():     # every row, one partition at a time
        print("\t".join("NULL" if v is None else str(v) for v in row))
    return 0


if __name__ == "__main__":
    sys.exit(main())
