"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (decontaminate, exact_dedup, fingerprints, language, line_dedup, mixing, ngram_join, periodic_runs,
               pseudonyms, sharding, target_resampling, token_store, toxicity)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mix_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(_documents(spark, sf_dir))


def op2_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(_documents(spark, sf_dir))


def op3_byte_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.digest(_documents(spark, sf_dir))


def op4_shard_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(_documents(spark, sf_dir))


def op5_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op7_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.digest(_documents(spark, sf_dir))


def op8_block_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.digest(_documents(spark, sf_dir))


def op9_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.digest(_documents(spark, sf_dir))


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.digest(_documents(spark, sf_dir))


def op11_basic_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(_documents(spark, sf_dir))


def op12_position_crc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_resampling.digest(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.digest(_documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline     # at the top of the repository; it imports this package

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_mix_cube, op2_fuzzy_lines, op3_byte_gru, op4_shard_feistel, op5_boosted_toxicity, op6_spaced_seeds, op7_parity_join,
    op8_block_names, op9_feistel_pseudonyms, op10_token_store, op11_basic_factors, op12_position_crc,
    op13_closed_syncmers, pipeline)}

SQL: dict[str, str] = {"op8_block_names": exact_dedup.SQL}
