"""From raw documents to token ids: five stages, each an operator of tributary.llm over all documents.

Every stage is written as Parquet into the shared folder and read again, so a later stage never computes
an earlier one anew, and a lost executor re-reads files. A written stage goes when the next one is done.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tributary.llm import bpe, decontam, ngram_join, quality, substring
from tributary.llm.steps import Steps

VOCABULARY = "byte_bpe_50k.json"
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80
PASSAGE_WORDS = 50


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the likelihood ratio reject go."""
    return quality.kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar shingle sets, the one with the smallest id stays."""
    return ngram_join.one_of_each(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that a document with a smaller id holds too are cut out."""
    return substring.deduplicated(docs, PASSAGE_WORDS)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of ids and decoded text, and the ids, packed."""
    return bpe.round_trip_digests(docs, public_tokenizers.path(VOCABULARY), with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_passages", benchmark_passages),
    ("token_ids", token_ids),
]

# Hashing, retrieval and the tokenizer are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, steps, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), Steps(spark), None
    for name, stage in STAGES[:-1]:
        docs = steps.keep(stage(spark, docs, sf_dir), name)
        if before:
            steps.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
