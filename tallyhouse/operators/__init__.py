"""Relational operators the reference relies on that Spark has no single call for."""

from tallyhouse.operators.audit import classify, snapshot
from tallyhouse.operators.dedup import keep_first, keep_last
from tallyhouse.operators.ntile import ntile
from tallyhouse.operators.upsert import insert_ignore, upsert, upsert_ordered

__all__ = ["classify", "snapshot", "keep_first", "keep_last", "ntile",
           "insert_ignore", "upsert", "upsert_ordered"]
