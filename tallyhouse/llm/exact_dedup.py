"""Exact duplicates by deterministic block naming.

Each normalised text (every ASCII white-space character deleted) is cut into blocks of a fixed
number of characters. The distinct blocks are sorted and get integer names; then the names of
adjacent pairs are named in the same way, level by level, until every document has a single
name. Two documents are equal exactly when they have as many blocks and the same final name.

Names are free of collisions: rows are shuffled by a 64-bit hash of the block, and a hash is
used in place of its content only after counting that it has one content in the whole table.
The blocks of all other hashes are named by content.

Defined results: null counts as empty text; empty texts are one group; ties in the number of
code points go to the smallest doc_id, nulls last, and among repeated rows one is kept; an empty
table gives no rows. Only doc_id and text are read; other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, staged

BLOCK = 1024


def block_hash(block: Column) -> Column:
    return F.xxhash64(block)


def _blocks(norm: Column, block: int) -> Column:
    """Blocks of ``block`` characters in order; an empty text is one empty block."""
    cut = F.regexp_extract_all(norm, F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    return F.when(norm == "", F.array(F.lit(""))).otherwise(cut)


def _integer_names(df: DataFrame, *keys: str) -> DataFrame:
    """A dense-enough integer name per row of ``df`` (distinct keys): its place in the sorted
    order of its hash partition, partitions one after another."""
    return staged(df.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id()),
                  "names")


def identities(documents: DataFrame, block: int = BLOCK,
               hasher: Callable[[Column], Column] = block_hash) -> DataFrame:
    """One row per document: rid (row id), doc_id, chars, text_sha256, blocks, name; equal texts
    are those with equal (blocks, name)."""
    norm = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), SPACE, "")
    base = documents.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("chars"),
                            norm.alias("norm"))
    parts = base.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "chars",
                        F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
                        _blocks(F.col("norm"), block).alias("parts"))
    docs = staged(parts.select("rid", "doc_id", "chars", "text_sha256", F.size("parts").alias("blocks"),
                               F.transform("parts", hasher).alias("hashes")), "docs")

    # level 0: name the distinct blocks; contents cross the network once
    # outer: the filter Spark infers for an inner generator would cut the text a second time
    content = base.select(F.explode_outer(_blocks(F.col("norm"), block)).alias("block"))
    distinct = content.groupBy(hasher(F.col("block")).alias("hash"), "block").agg(F.lit(1).alias("_"))
    names = staged(distinct.sortWithinPartitions("hash", "block").select(
        "hash", F.monotonically_increasing_id().alias("name")), "block_names")
    shared = staged(names.groupBy("hash").count().filter("count > 1").select("hash"), "shared_hashes")
    single = names.join(shared, "hash", "left_anti")
    cells = docs.select("rid", "blocks", F.posexplode("hashes").alias("pos", "hash"))
    level = cells.join(single, "hash").select("rid", "blocks", "pos", "name")
    if not shared.isEmpty():
        level = level.union(_by_content(documents, docs, shared, block, hasher))
    level = staged(level, "level")

    finished = level.filter("blocks = 1").select("rid", "name")
    level = level.filter("blocks > 1").withColumnRenamed("blocks", "width")
    depth, most = 1, docs.agg(F.max("blocks")).first()[0] or 0
    while depth < most:
        depth *= 2
        half = F.floor(F.col("pos") / 2).cast("int")
        pairs = staged(level.groupBy("rid", "width", half.alias("pos")).agg(
            F.max(F.when(F.pmod("pos", F.lit(2)) == 0, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(F.pmod("pos", F.lit(2)) == 1, F.col("name"))), F.lit(-1)).alias("right")),
            "pairs")
        named = _integer_names(pairs.select("left", "right").distinct(), "left", "right")
        width = F.ceil(F.col("width") / 2).cast("int")
        level = staged(pairs.join(named, ["left", "right"]).select(
            "rid", width.alias("width"), "pos", "name"), "level")
        finished = finished.union(level.filter("width = 1").select("rid", "name"))
        level = level.filter("width > 1")
    return docs.drop("hashes").join(staged(finished, "identity"), "rid")


def _by_content(documents: DataFrame, docs: DataFrame, shared: DataFrame, block: int,
                hasher: Callable[[Column], Column]) -> DataFrame:
    """Blocks whose hash has several contents, named by content (names below zero)."""
    norm = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), SPACE, "")
    # the row is found again by its identity columns; the block itself is taken from the text
    again = documents.select("doc_id", F.sha2(norm.cast("binary"), 256).alias("text_sha256"),
                             _blocks(norm, block).alias("parts")).dropDuplicates(["doc_id", "text_sha256"])
    cells = again.select("doc_id", "text_sha256", F.posexplode("parts").alias("pos", "block"))
    cells = staged(cells.withColumn("hash", hasher(F.col("block"))).join(shared, "hash", "left_semi"), "cells")
    named = _integer_names(cells.select("block").distinct(), "block")
    keyed = cells.join(named, "block").select(F.col("doc_id").alias("_d"), F.col("text_sha256").alias("_t"),
                                              "pos", (-2 - F.col("name")).alias("name"))
    rows = docs.select("rid", "doc_id", "text_sha256", "blocks")
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_sha256") == F.col("_t"))
    return rows.join(keyed, same).select("rid", "blocks", "pos", "name")


def exact_duplicates(documents: DataFrame, block: int = BLOCK,
                     hasher: Callable[[Column], Column] = block_hash) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and the block name, one row per document."""
    ids = staged(identities(documents, block, hasher), "identities")
    rank = F.struct((-F.col("chars")).alias("c"), F.col("doc_id").isNull().alias("n"),
                    F.col("doc_id").alias("d"), F.col("rid").alias("r"))
    groups = ids.groupBy("blocks", "name").agg(F.count("*").alias("group_size"), F.min(rank).alias("best"))
    return ids.join(groups, ["blocks", "name"]).select(
        "doc_id", F.col("best.d").alias("keep_id"), "group_size",
        (F.col("best.r") == F.col("rid")).alias("kept"), "text_sha256", "blocks", "name")


SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(length(text), 0) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (
  SELECT norm, count(*) AS group_size, arg_min(doc_id, struct_pack(c := -chars, d := doc_id)) AS keep_id
  FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size,
       t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g ON t.norm = g.norm
"""


def digest(documents: DataFrame) -> DataFrame:
    """The query."""
    return exact_duplicates(documents).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
