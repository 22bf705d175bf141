"""Queries of operators that compare texts, vectors or words with each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanweave.llm import hard_negatives, spelling_variants, suffix_dedup
from loanweave.llm.common import table


def op11_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedup(table(spark, sf_dir, "documents", "doc_id", "text"), digest=True)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.lower(F.hex("kept")).alias("kept_sha256"))


def op12_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_spelling_variant_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling_variants.group(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {q.__name__: q for q in (op11_suffix_array_dedup, op12_hard_negative_mining, op13_spelling_variant_grouping)}
