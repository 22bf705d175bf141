"""Queries of operators that scan texts in Arrow batches."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanweave.llm import bpe, decontamination, jaccard_join, lm_scoring
from loanweave.llm.common import table


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontamination.find(docs, items).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents", "doc_id", "text"))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.join(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "class_id", "n_links", "n_copies")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    out = bpe.round_trip(table(spark, sf_dir, "documents", "doc_id", "text"), path)
    return out.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {q.__name__: q for q in (op1_ngram_jaccard_join, op4_lm_scoring, op6_benchmark_decontamination, op7_bpe)}
