"""Corpus pipeline: documents through filters, near-duplicate removal, decontamination and BPE.

Each stage takes what its predecessor kept, written as Parquet and read again, and returns
the columns of ``documents``; the last one returns the token ids and the digest of the text
that they decode to.

- ``quality``: documents that the quality classifier scores below 0.5 go.
- ``toxicity``: documents that the toxicity model scores 0.5 or more go.
- ``near_duplicates``: of each class of near-duplicates, the document with the smallest id stays.
- ``decontamination``: documents that hold a window of ``benchmark`` go.
- ``bpe``: every document is encoded, and its ids are decoded again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanweave.llm import bpe, decontamination, jaccard_join, quality_classifier, toxicity
from loanweave.llm.common import table
from loanweave.sources.staging import scratch, stage

TOKENIZER = "byte_bpe_50k.json"


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = quality_classifier.score(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return scored.where("score >= 0.5").select(docs.columns)


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def _decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.remove(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def _bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.encode_and_decode(docs, public_tokenizers.path(TOKENIZER))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", _quality),
    ("toxicity", _toxicity),
    ("near_duplicates", _near_duplicates),
    ("decontamination", _decontamination),
    ("bpe", _bpe),
]

ORACLE_SQL = None  # models and BPE have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        with scratch(spark):  # what a stage's operators have staged goes once its result is written
            docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
