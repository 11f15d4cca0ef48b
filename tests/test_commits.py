"""Versions claimed by compare and set; overlapping refreshes; the compacted audit log."""

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tallyhouse.operators import audit as A
from tallyhouse.plans import refresh as R
from tallyhouse.plans.layers import feeds_from_tables
from tallyhouse.session import fresh_scratch_path
from tallyhouse.sources import warehouse as W
from tallyhouse.sources.commits import CommitConflict, CommitLog, FileSystem
from tests.conftest import SMALL

T0 = dt.datetime(2025, 1, 1)


def test_one_of_many_writers_wins_each_version(spark):
    log = CommitLog(spark, fresh_scratch_path(spark, "log"))
    assert log.latest() == 0 and log.entry(0) == {}

    def attempt(i):
        try:
            return log.commit(log_base, {"who": i})
        except CommitConflict:
            return None

    for log_base in range(4):
        with ThreadPoolExecutor(8) as pool:
            won = [v for v in pool.map(attempt, range(8)) if v]
        assert won == [log_base + 1] and log.latest() == log_base + 1
    assert sorted(os.listdir(log.folder)) == [f"{v:020d}.json" for v in range(1, 5)]
    rows = log.entries("version long, who long", after=1, until=3).collect()
    assert sorted(r.version for r in rows) == [2, 3] and all(r.who in range(8) for r in rows)
    with pytest.raises(CommitConflict):
        log.commit(2, {})


def test_rename_never_replaces(spark):
    """The way taken on file systems other than the local one."""
    fs = FileSystem(spark)
    folder = fresh_scratch_path(spark, "rename")
    os.makedirs(folder)
    done = []
    for text in ("one", "two"):
        with open(f"{folder}/draft-{text}", "w") as f:
            f.write(text)
        where, client = fs._path(f"{folder}/draft-{text}")
        done.append(fs._renamed(client, where, fs._path(f"{folder}/final")[0]))
    assert done == [True, False] and fs.read(f"{folder}/final") == "one"


def test_overlapping_refreshes(spark):
    root = fresh_scratch_path(spark, "wh")
    feeds = feeds_from_tables(spark, SMALL)
    slow = R.prepare_refresh(spark, feeds, root, T0 + dt.timedelta(days=5))
    quick = R.run_refresh(spark, feeds, root, T0)
    wh = W.Warehouse(spark, root)
    with pytest.raises(CommitConflict):
        slow.publish()
    assert wh.published_runs() == [quick.run_id] and wh.version() == 1
    assert os.listdir(f"{root}/runs") == os.listdir(f"{root}/audit") == [f"run_id={quick.run_id}"]
    # what lost is run again from the version that won; its audit sees that one
    again = R.run_refresh(spark, feeds, root, T0 - dt.timedelta(days=1))
    assert wh.current_run() == again.run_id and wh.run_at(1) == quick.run_id
    assert {r.change_type for r in wh.audit_history().filter("version = 2").collect()} == {"unchanged"}
    pinned = R.published_marts(spark, root, version=1).fact
    assert all(quick.run_id in f for f in pinned.inputFiles())


def fake_runs(wh, first, last):
    """Audit folders and versions of runs, without running them."""
    for v in range(first, last + 1):
        rows = [("a", 100 + v % 7, v), ("b", 5, 5)] if v % 10 else [("c", v, v)]
        table = pa.table({
            "source_name": [r[0] for r in rows], "observed_rows": [r[1] for r in rows],
            "observed_fingerprint": [r[2] for r in rows], "change_type": ["unchanged"] * len(rows),
            "observed_at": pa.array([T0] * len(rows), pa.timestamp("us")),
            **{c: pa.nulls(len(rows), pa.int64()) for c in (
                "previous_rows", "previous_fingerprint", "delta_rows", "new_rows", "removed_rows")}})
        os.makedirs(f"{wh.audit_path}/run_id=r{v}")
        pq.write_table(table, f"{wh.audit_path}/run_id=r{v}/x.parquet")
        wh.publish(f"r{v}", T0, v - 1)


def test_audit_of_hundreds_of_runs_reads_few_files(spark):
    wh = W.Warehouse(spark, fresh_scratch_path(spark, "wh"))
    done = 0
    for last in (31, 40, 130, 131, 300):
        fake_runs(wh, done + 1, last)
        done = last
        wh.compact_audit(wh.version())
    fake_runs(wh, 301, 320)
    assert [wh.checkpoints.entry(v)["until"] for v in range(1, wh.checkpoints.latest() + 1)] == [40, 130, 300]
    latest = wh.audit_latest()
    assert len(latest.inputFiles()) <= W.COMPACT_EVERY + 1
    full = wh.audit_history()
    assert full.count() == 2 * 288 + 32 and len(full.inputFiles()) <= W.COMPACT_EVERY + 3
    key = lambda df: sorted(map(str, A.latest_per_source(df).collect()))
    assert key(latest) == key(full) and latest.count() == 3
    # readers of an older version see the audit of that version
    assert {(r.source_name, r.version) for r in wh.audit_latest(129).collect()} == {("a", 129), ("b", 129), ("c", 120)}
    assert not wh.compact_audit(wh.version())
