"""Registered queries of the corpus operators, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (chat_format, exact_dedup, filter_audit, jaccard_join, license_scan, piece_codec, quality,
               secret_scan, source_mix, topk_search, toxicity, url_filter, vector_codes)
from .common import load

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(load(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(load(spark, sf_dir, "documents"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(load(spark, sf_dir, "documents")).drop("repeats")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.sql("select -1L conv_id, id turn, if(id = 0, 'user', 'assistant') role, "
                      "'</s>[INST] ok [/INST]' text from range(2)")
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    log = chat_format.message_log(rows.unionByName(added))
    return chat_format.chat_digests(chat_format.format_chats(log))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")).drop("row_mark")


def op6_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(load(spark, sf_dir, "embeddings"))


def op7_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encode_corpus(load(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(load(spark, sf_dir, "documents")).drop("row_mark")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(load(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(load(spark, sf_dir, "pages"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_vectors(load(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_secret_scan, op2_license_scan, op3_source_mix, op4_chat_format, op5_toxicity, op6_topk_search,
        op7_piece_codec, op8_exact_dedup, op9_jaccard_join, op10_url_filter, op11_filter_audit, op12_quality,
        op13_vector_codes)}
