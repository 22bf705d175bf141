"""Queries of operators that learn from labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanweave.llm import quality_classifier, quality_rules, toxicity
from loanweave.llm.common import table


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality")
    return quality_classifier.score(docs, labels).select("doc_id", "held_out", "score", "predicted")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality")
    return quality_rules.judge(docs, labels)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic")
    return toxicity.score(docs, labels)


QUERIES = {q.__name__: q for q in (op2_quality_classifier, op8_quality_rules, op10_toxicity)}
