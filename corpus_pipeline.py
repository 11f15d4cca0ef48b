"""A corpus pipeline over the training-data operators: every stage reads what the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every result as
Parquet in the shared folder and rereads it as the next stage's ``docs``. All stages but the last
return the columns of ``docs``; the last adds each row's place in the shards. ``docs`` may hold any
further columns: they pass through, also under names that an operator uses itself (sharding's own
columns replace those of their names). Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from tallyhouse.llm import decontaminate, mixing, ngram_join, sharding, toxicity
from tallyhouse.llm.common import sheltered, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.learn(docs.select("doc_id", "text"), labels)
    return sheltered(docs, ("doc_id", "text"), lambda rows: toxicity.score(rows, model).filter(
        "predicted = 0").select(*rows.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram Jaccard join: the one with the smallest
    doc_id; documents without words are components of their own."""
    return sheltered(docs, ("doc_id", "text"), lambda rows: ngram_join.linked_rows(rows).filter(
        "_first").select(*rows.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix to the sources' target weights: every document as often as it is taken."""
    return sheltered(docs, ("doc_id", "text", "source"), lambda rows: mixing.repeated(
        mixing.mix(rows), rows.columns))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their place (row_no, position, shard, slot) in the reproducible shuffle. Rows of
    one doc_id (or none) follow the hash of all their columns, so that the layout of the input does
    not matter; rows equal in every column are interchangeable."""
    tie = "tie"
    while tie in docs.columns:
        tie += "_"
    plain = ["`" + f.name.replace("`", "``") + "`" for f in docs.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    return sharding.shard(docs.withColumn(tie, F.xxhash64(*plain)), ties=(tie,)).drop(tie)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

ORACLE_SQL = None     # trees, components and the cube method are beyond SQL; tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
