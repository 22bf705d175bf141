"""Registered queries: SQL where there is some, the pipeline by its parts."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from loanweave.llm import decontamination, jaccard_join, quality_classifier, registry, toxicity
from loanweave.sources.staging import staging_root
from tests.llm.helpers import awkward

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_all_are_registered():
    assert set(registry.QUERIES) | {"pipeline"} <= set(contract.queries())
    assert sorted(int(q[2:].split("_")[0]) for q in registry.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("key", sorted(registry.ORACLE))
def test_equals_sql(spark, con, key):
    df = registry.QUERIES[key](spark, SF)
    columns = sorted(df.columns)
    want = con.execute(registry.ORACLE[key])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    sort = lambda rows: sorted(rows, key=repr)
    assert sort(tuple(r[c] for c in columns) for r in df.collect()) == sort(tuple(r[names.index(c)] for c in columns) for r in want.fetchall())


def test_pipeline(spark):
    """Each stage keeps what its operator, asked on its own, says about the stage's input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, items = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    verdicts = {
        "quality": lambda d: quality_classifier.score(d, labels).where("predicted = 1"),
        "toxicity": lambda d: toxicity.score(d, labels).where("predicted = 0"),
        "near_duplicates": lambda d: jaccard_join.join(d).where("doc_id = class_id"),
        "decontamination": lambda d: decontamination.find(d, items).where("n_hit = 0").select(F.col("id").alias("doc_id")),
    }
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, SF).cache()
        assert out.columns == docs.columns
        assert ids(out) == ids(verdicts[name](docs)), name
        assert out.count() < docs.count()
        docs = out
    coded = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert ids(coded) == ids(docs) and coded.where("n_tokens != size(ids)").count() == 0
    there = lambda: set(os.listdir(staging_root(spark).removeprefix("file:")))
    before = there()
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()) == ids(docs)
    # what the stages' operators staged is gone, but for the last stage, whose result is not written
    assert {name.split("-")[0] for name in there() - before} == {"pipeline", "bpe"}


def test_stages_with_awkward_rows(spark):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    docs = awkward(spark).selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "length(text) AS n_chars").select(*columns)
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, docs, SF).columns == columns
        assert step(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_last_stage_decodes(spark):
    docs = awkward(spark)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    want = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("decoded_sha256"))
    pairs = lambda df: sorted((str(r.doc_id), r.decoded_sha256) for r in df.select("doc_id", "decoded_sha256").collect())
    assert pairs(out) == pairs(want)
