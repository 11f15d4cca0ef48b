"""Benchmark: one full refresh from the benchmark tables, the same refresh from the feeds
landed as CSV / JSON files, then the 19 catalogue queries over the published marts.
Prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyhouse.plans import queries as Q  # noqa: E402
from tallyhouse.plans import refresh as R  # noqa: E402
from tallyhouse.plans.layers import feeds_from_tables  # noqa: E402
from tallyhouse.session import build_session, fresh_scratch_path  # noqa: E402

COUNTRY = "NAA"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    timings: dict[str, float] = {}

    # Untimed warm-up on the smallest tables: JVM class loading and code generation are
    # paid once here, not inside the measured run.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        warm_root = fresh_scratch_path(spark, "bench-warmup")
        R.run_refresh(spark, feeds_from_tables(spark, warm_dir), warm_root, dt.datetime(2024, 1, 1))
        warm = R.published_marts(spark, warm_root)
        for name, fn in Q.CATALOGUE.items():
            (fn(warm, COUNTRY) if name in Q.COUNTRY_QUERIES else fn(warm)).collect()

    root = fresh_scratch_path(spark, "bench-warehouse")
    t0 = time.perf_counter()
    result = R.run_refresh(spark, feeds_from_tables(spark, sf_dir), root,
                           dt.datetime(2025, 1, 1))
    timings["refresh"] = time.perf_counter() - t0

    # The same refresh from landed files (rate CSVs + population JSON), the form in which
    # the inputs arrive in production. Landing the files is not timed.
    from tallyhouse.sources import files, testfeeds
    landing = fresh_scratch_path(spark, "bench-landing")
    files.write_rate_csv(testfeeds.employment_feed(spark, sf_dir).orderBy("_pos"), f"{landing}/employment")
    files.write_rate_csv(testfeeds.unemployment_feed(spark, sf_dir).orderBy("_pos"), f"{landing}/unemployment")
    files.write_population_json(testfeeds.population_objects(spark, sf_dir), f"{landing}/population")
    t0 = time.perf_counter()
    from_files = R.run_refresh(
        spark, R.feeds_from_files(spark, f"{landing}/employment", f"{landing}/unemployment",
                                  f"{landing}/population"),
        fresh_scratch_path(spark, "bench-warehouse-files"), dt.datetime(2025, 1, 2))
    timings["refresh_from_files"] = time.perf_counter() - t0
    assert from_files.metrics == result.metrics, "file and table inputs disagree"

    marts = R.published_marts(spark, root, result.run_id)
    for name, fn in Q.CATALOGUE.items():
        t = time.perf_counter()
        df = fn(marts, COUNTRY) if name in Q.COUNTRY_QUERIES else fn(marts)
        df.collect()
        timings[name] = time.perf_counter() - t

    # The mart side on data that grows: codes from the customer key (not part of the total).
    from tallyhouse.plans.layers import written_marts
    wide: dict[str, float] = {}
    t = time.perf_counter()
    grown = written_marts(spark, sf_dir, wide=True)
    wide["write_marts"] = time.perf_counter() - t
    wide_rows = grown.fact.count()
    for name, fn in Q.CATALOGUE.items():
        t = time.perf_counter()
        (fn(grown, "AAB") if name in Q.COUNTRY_QUERIES else fn(grown)).collect()
        wide[name] = time.perf_counter() - t

    total = sum(timings.values())
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "refresh_tables_plus_refresh_files_plus_19_queries_wall",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in timings.items()},
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "rows": result.metrics,
        "refresh_steps": result.seconds,
        "wide_marts": {k: round(v, 3) for k, v in wide.items()},
        "wide_fact_rows": wide_rows,
        "warmup": os.path.isdir(warm_dir),
    }))


if __name__ == "__main__":
    main()
