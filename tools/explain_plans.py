"""Record the executed physical plans of the headline operators (key lines only).

Usage: python tools/explain_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import datetime as dt
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyhouse.plans import queries as Q  # noqa: E402
from tallyhouse.plans import refresh as R  # noqa: E402
from tallyhouse.plans import staging as S  # noqa: E402
from tallyhouse.plans.layers import feeds_from_tables, layers_from_tables  # noqa: E402
from tallyhouse.session import build_session, fresh_scratch_path  # noqa: E402
from tallyhouse.sources.warehouse import INGESTION, Warehouse  # noqa: E402

KEY = re.compile(r"(Exchange|Aggregate|Join|TakeOrdered|Scan parquet|FileScan|PartitionFilters|"
                 r"PushedFilters|ReusedExchange|Window|Subquery|CollectMetrics|Sort \[|"
                 r"AQEShuffleRead|BroadcastExchange|Generate)")


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _bracketed(line: str, label: str) -> str | None:
    """The balanced ``[...]`` value that follows ``label`` in ``line``."""
    start = line.find(label)
    if start < 0:
        return None
    i = start + len(label)
    depth = 0
    for j in range(i, len(line)):
        if line[j] == "[":
            depth += 1
        elif line[j] == "]":
            depth -= 1
            if depth == 0:
                return line[i:j + 1]
    return line[i:]


def key_lines(plan: str, width: int = 170) -> list[str]:
    # Only the final plan: the top-level "Initial Plan" marker starts at column 0.
    final = re.split(r"(?m)^\+- == Initial Plan ==", plan)[0]
    out = []
    for line in final.splitlines():
        if not KEY.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^,\]]*\]?", "Location: ...", line)
        out.append(line[:width])
        if "FileScan" in line:
            indent = " " * (len(line) - len(line.lstrip()) + 3)
            for key in ("PartitionFilters", "PushedFilters"):
                value = _bracketed(line, key + ": ")
                if value is not None:
                    out.append(f"{indent}{key}: {value[:width]}")
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    root = fresh_scratch_path(spark, "plans")
    R.run_refresh(spark, feeds_from_tables(spark, sf_dir), root, dt.datetime(2025, 1, 1))
    marts = R.published_marts(spark, root)
    lazy = layers_from_tables(spark, sf_dir)
    wh_raw = Warehouse(spark, root).read(INGESTION, R.RAW_UNEMPLOYMENT)
    cases = {
        "staging keep-first on the landed raw table (partial + final aggregate)":
            S.stage_rates(wh_raw, "unemployment_rate"),
        "rate fact, lazily composed (AQE picks the join from measured sizes)": lazy.fact,
        "q03 on published marts (latest year pruned by partition filter, top-k)": Q.q03(marts),
        "q04 on published marts (country filter pushed to the scan)": Q.q04(marts, "NAA"),
        "q07 on published marts (distinct count)": Q.q07(marts),
        "q19 on published marts (NTILE from one sorted copy, no single-partition window)": Q.q19(marts),
    }
    print("# PLANS\n")
    print(f"Executed physical plans (AQE final plans, key operators only) at `{sf_dir}`,")
    print("`local[8]`, 8 shuffle partitions. Produced by `python tools/explain_plans.py`.\n")
    for title, df in cases.items():
        print(f"## {title}\n\n```")
        print("\n".join(key_lines(executed(df))))
        print("```\n")


if __name__ == "__main__":
    main()
