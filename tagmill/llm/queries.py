"""Queries and oracle SQL of this subpackage, by name."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tagmill.llm import ann, bpe_codec, fill_in_middle, katz, language_id, lexical, media, near_dedup, packing, pii, quality, substring_dedup, token_counts


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_bins(_documents(spark, sf_dir))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.codec_report(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_report(_documents(spark, sf_dir))


def op5_katz_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.katz_scores(_documents(spark, sf_dir))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_report(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_report(_documents(spark, sf_dir))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats_report(_documents(spark, sf_dir))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_report(_documents(spark, sf_dir))


def op10_additive_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours_report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranking_report(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.middle_report(_documents(spark, sf_dir))


def op13_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(_documents(spark, sf_dir))


_QUERIES = [
    op1_best_fit_packing,
    op2_quality_classifier,
    op3_bpe_codec,
    op4_media_columns,
    op5_katz_scoring,
    op6_token_counts,
    op7_minhash_near_dedup,
    op8_substring_dedup,
    op9_language_id,
    op10_additive_ann,
    op11_lexical_search,
    op12_fill_in_middle,
    op13_pii_spans,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op11_lexical_search": lexical.RANKING_SQL, "op12_fill_in_middle": fill_in_middle.MIDDLE_SQL}
