"""From raw documents to packed token sequences: quality rules, near duplicates, repeated passages,
benchmark passages, packing. Every stage works on what its predecessor kept, written as Parquet in between."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from peakflow.llm import decontaminate, jaccard_join, packing, quality_rules, substring_dedup
from peakflow.sources.staging import staging_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule go."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by word 5-grams at a similarity of 0.8 the smallest doc_id stays."""
    return jaccard_join.keep_one(docs, size=5, num=80, den=100)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words under a 13-word window of an earlier document are cut."""
    return substring_dedup.cut_documents(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a 10-word window of a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.clean_documents(docs, benchmark)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all remaining documents with their place in sequences of 1024."""
    return packing.pack(docs, packing.tokenizer_path())


STAGES = [
    ("quality_rules", quality), ("ngram_jaccard_join", near_duplicates), ("substring_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_passages), ("best_fit_packing", packed),
]

ORACLE_SQL = None  # components, greedy packing and token ids have no SQL; compared with plain Python in tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{staging_dir(spark).rstrip('/')}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
