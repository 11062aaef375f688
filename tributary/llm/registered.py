"""Registered queries of this subpackage: each runs one operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tributary.llm import align, bpe, decontam, html_crf, lm_score, merkle, ngram_join, preference, quality, substring, token_files, url_filter, warc

PIECES = "piece_bpe_32k.model"
VOCABULARY = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"), least_bytes=0)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.component_table(table(spark, sf_dir, "documents"), words=4, percent=85)


def op3_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.preference_pairs(table(spark, sf_dir, "conversations"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.scores(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.removal_digests(table(spark, sf_dir, "documents"), length=13)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), end_id=2)


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op8_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.extracted(table(spark, sf_dir, "pages"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.verdicts(table(spark, sf_dir, "pages"), spark.createDataFrame(url_filter.ENTRIES, "rule string, verdict string"))


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path(VOCABULARY), public_tokenizers.path(PIECES)
    return align.Alignment(table(spark, sf_dir, "documents"), *paths).digests()


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_documents(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_warc_round_trip": op1_warc_round_trip,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_preference_pairs": op3_preference_pairs,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_token_files": op6_token_files,
    "op7_bpe_round_trip": op7_bpe_round_trip,
    "op8_html_main_text": op8_html_main_text,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_quality_rules": op10_quality_rules,
    "op11_url_filter": op11_url_filter,
    "op12_cross_tokenizer_alignment": op12_cross_tokenizer_alignment,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLES: dict[str, str] = {
    "op3_preference_pairs": preference.ORACLE,
    "op11_url_filter": url_filter.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
