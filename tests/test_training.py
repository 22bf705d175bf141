from __future__ import annotations

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from loanweave.operators import training as M
from loanweave.sources.writers import load_model, write_features


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(600).selectExpr(
        "CAST(id AS BIGINT) AS SK_ID_CURR",
        "CAST(id % 3 = 0 AS INT) AS TARGET",
        "CASE WHEN id % 7 = 0 THEN NULL ELSE CAST(id % 3 AS DOUBLE) + rand(1) END AS x",
        "CAST(id % 11 AS INT) AS y",
        "'text' AS t",
    ).cache()


def test_feature_columns(table):
    assert M.feature_columns(table) == ["x", "y"]


def test_int_mean_is_cut(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (4,), (None,)], "a BIGINT")
    assert [r.a_imp for r in M.imputed(df, ["a"]).collect()][-1] == 2


def test_zero_variance_and_null_rows(spark):
    df = spark.createDataFrame([(3.0, 1.0), (3.0, 2.0), (3.0, None)], "a DOUBLE, b DOUBLE")
    out = M.scaled_features(df, ["a", "b"]).select(vector_to_array("scaled_features").alias("v")).collect()
    assert [r.v[0] for r in out] == [0.0, 0.0]


def test_ratio_by_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.0), (1.0, 2.0, 4.0)], "AMT_CREDIT DOUBLE, AMT_ANNUITY DOUBLE, AMT_INCOME_TOTAL DOUBLE")
    assert [tuple(r)[3:] for r in M.with_ratios(df).collect()] == [(None, None), (0.25, 0.5)]


def test_split_is_stable_and_complete(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    train, test = M.split_by_key(df, "k")
    again, _ = M.split_by_key(df.repartition(9), "k")
    ids = {r.k for r in train.collect()}
    assert ids == {r.k for r in again.collect()}
    assert not ids & {r.k for r in test.collect()} and train.count() + test.count() == 2000
    assert 0.75 < train.count() / 2000 < 0.85
    first, second = M.split_random(df)
    assert first.count() + second.count() == 2000


def test_auc_of_perfect_and_reversed_score(spark):
    df = spark.range(100).selectExpr("CAST(id >= 50 AS DOUBLE) AS TARGET", "CAST(id AS DOUBLE) AS s")
    assert M.auc(df, "TARGET", "s", bins=0) == 1.0
    assert M.auc(df.withColumn("s", -F.col("s")), "TARGET", "s", bins=0) == 0.0


def test_train_save_load(table, tmp_path):
    scores, models = M.train_and_evaluate(table, save_to=str(tmp_path))
    rows = {r.model: r.auc for r in scores.collect()}
    assert set(rows) == {"LogisticRegression", "RandomForest"}
    assert all(0.5 <= v <= 1 for v in rows.values())
    loaded = load_model(f"{tmp_path}/model_LogisticRegression")
    pick = lambda m: [r.probability for r in m.transform(table).orderBy("SK_ID_CURR").limit(20).collect()]
    assert pick(loaded) == pick(models["LogisticRegression"])
    with pytest.raises(ValueError):
        M.train_and_evaluate(table, split="other")


def test_application_features_are_stored_as_vectors(spark, tmp_path):
    df = spark.range(20).selectExpr(
        "id AS SK_ID_CURR", "1 AS TARGET", "id * 2D AS AMT_CREDIT", "id * 1D AS AMT_ANNUITY", "id + 1D AS AMT_INCOME_TOTAL"
    )
    write_features(M.application_features(df), str(tmp_path / "v"), ("SK_ID_CURR", "TARGET", "scaled_features"))
    back = spark.read.parquet(str(tmp_path / "v"))
    assert back.count() == 20 and back.first().scaled_features.size == 5
