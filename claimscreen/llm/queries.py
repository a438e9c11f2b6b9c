"""One query for each corpus operator, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from claimscreen.llm import decontaminate, lines, mixing, quality, repeats, simhash, tokencount, tokenstore, toxicity, windows
from claimscreen.llm.common import documents, work_path


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return tokencount.token_counts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "tokens")
    tokenstore.write_store(documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return tokenstore.read_digests(spark, path)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), max_bits=2, shingle=3)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir)).drop("host", "key")


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(documents(spark, sf_dir), length=400)


def op6_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.remove_repeated_windows(documents(spark, sf_dir), window=13)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source", "shard", "rank")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("key", "key2")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_counts(documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_token_counts, op2_token_store, op3_simhash, op4_quality, op5_repeats, op6_windows, op7_mixing, op8_decontaminate, op9_toxicity, op10_lines]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {}
