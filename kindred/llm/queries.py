"""Queries of the training-data operators, for __spark_entry__."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kindred.llm import byte_bpe, licenses, ngram_join, packing, pivot_topk, quality_knn, quality_rules, token_counts, url_filter, warc
from kindred.session import table


def op1_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.op1(table(spark, sf_dir, "pages"))


def op2_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_knn.op2(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.op3(table(spark, sf_dir, "pages"))


def op4_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_topk.op4(table(spark, sf_dir, "embeddings"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.op5(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.op6(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.op7(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048, 0)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.code_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_warc_segments,
        op2_quality_knn,
        op3_url_filter,
        op4_pivot_topk,
        op5_license_scan,
        op6_quality_rules,
        op7_token_counts,
        op8_ngram_jaccard,
        op9_best_fit_packing,
        op10_byte_bpe,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op4_pivot_topk": pivot_topk.ORACLE}
