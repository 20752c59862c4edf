"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, chat_format, cross_tokens, decontaminate, hard_negatives, licenses, line_dedup, mixing, ngram_join, quality_rules, toxicity, url_filter, weak_quality
from .common import table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.classify(table(spark, sf_dir, "documents"))


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("detections")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("rejected_by")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = chat_format.with_rejected(chat_format.conversations(table(spark, sf_dir, "conversations")))
    return chat_format.format_preferences(pairs)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return rows.select("doc_id", "source", "text", "n_lines", "n_dropped")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_components(table(spark, sf_dir, "documents")).drop("links")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = cross_tokens.read_models(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return cross_tokens.align(table(spark, sf_dir, "documents"), *models, digest=True).withColumnRenamed("groups", "groups_sha256")


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def queries() -> dict:
    return {f.__name__: f for f in (op1_quality_classifier, op2_license_scans, op3_quality_rules, op4_toxicity, op5_chat_formatting, op6_benchmark_decontamination, op7_url_filters, op8_line_dedup, op9_mixing, op10_ngram_jaccard_join, op11_hard_negatives, op12_cross_tokenizer_alignment, op13_byte_bpe)}
