"""A corpus from raw documents to token shards: quality, near duplicates, benchmark passages, mix, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from claimscreen.llm import decontaminate, mixing, quality, simhash, tokenstore
from claimscreen.llm.common import documents, stored, work_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines those remove."""
    return quality.clean(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates: a similarity of 0.8 over shingles of five words."""
    return simhash.keep_one(docs, similarity=0.8, verify=5)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.apply_mix(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' ids in binary shards, as read back: doc_id, start, n_tokens, ids_crc32."""
    path = work_path(spark, "pipeline-tokens")
    tokenstore.write_store(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return tokenstore.read_digests(spark, path)


STAGES = [
    ("quality rules", quality_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixing sources", mixing_stage),
    ("token ids", token_stage),
]
#: SQL cannot express the later stages; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
