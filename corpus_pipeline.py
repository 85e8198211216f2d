"""A corpus pipeline of four stages over documents. Each stage reads what the one before it wrote.

quality classifier: documents with a score below 0.5 go.
quality rules: documents that the base rule or a learned rule rejects go.
n-gram Jaccard join: one document of each component stays, the one of the smallest id.
best-fit packing: what is left becomes token pieces with their places in sequences.

Labels come from sf_dir; nulls, empty texts, repeated rows and empty tables are handled as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kindred.llm import ngram_join, packing, quality_knn, quality_rules
from kindred.session import scratch, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_knn.fit(docs, table(spark, sf_dir, "labels"))
    return quality_knn.kept(docs, model).select(*COLUMNS)


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rules = quality_rules.learn_from(docs, table(spark, sf_dir, "labels"))
    return quality_rules.kept(docs, rules).select(*COLUMNS)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2048, 0)


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules_stage),
    ("n-gram Jaccard join", jaccard_join),
    ("best-fit packing", best_fit_packing),
]

#: A classifier fitted on labels and a tokenizer are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = scratch(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
