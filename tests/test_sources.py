from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from loanweave import __main__ as cli
from loanweave.plans import features, prepare
from loanweave.operators import checks
from loanweave.sources import readers, staging, tables, writers


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('k,a,s\n1,10,x\n2,,""\n3,XNA,XNA\n4,7,y\n')
    return str(path)


def test_null_token(spark, csv):
    with_token = readers.read_csv(spark, csv, None, "XNA")
    assert dict(with_token.dtypes)["a"] == "int"
    assert [r.a for r in with_token.orderBy("k").collect()] == [10, None, None, 7]
    assert [r.s for r in with_token.orderBy("k").collect()] == ["x", "", None, "y"]
    without = readers.read_csv(spark, csv)
    assert dict(without.dtypes)["a"] == "string"
    assert [r.a for r in without.orderBy("k").collect()] == ["10", None, "XNA", "7"]


def test_declared_schema_and_header_check(spark, csv):
    df = readers.read_csv(spark, csv, "k BIGINT, a DOUBLE, s STRING", "XNA")
    assert [r.a for r in df.orderBy("k").collect()] == [10.0, None, None, 7.0]
    assert readers.infer_schema(spark, csv, "XNA").fieldNames() == ["k", "a", "s"]
    with pytest.raises(Exception):
        readers.read_csv(spark, csv, "k BIGINT, other DOUBLE, s STRING", "XNA").collect()


def test_write_counted_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "p")
    assert writers.write_counted(spark.range(5), path) == 5
    assert writers.write_counted(spark.range(3), path) == 3
    assert list((tmp_path / "p").glob("*.snappy.parquet"))


def test_load_existing(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "a"))
    found, missing = tables.load_existing(spark, {"a": str(tmp_path / "a"), "b": str(tmp_path / "b")})
    assert list(found) == ["a"] and missing == ["b"]


def test_staging_uses_the_session_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert staging.staging_path(spark, "x").startswith(root)
    assert staging.staging_path(spark, "x") != staging.staging_path(spark, "x")
    df = staging.stage(spark.range(4).withColumn("v", F.lit("a")), "t")
    assert df.count() == 4 and "FileScan" in df._jdf.queryExecution().executedPlan().toString()


def test_staged_copy_is_removed(spark, tmp_path):
    with staging.staged(spark.range(4), "once") as df:
        path = df.inputFiles()[0]
        assert df.count() == 4 and os.path.exists(path.removeprefix("file://"))
    assert not os.path.exists(path.removeprefix("file://"))


def raw_tables(spark, root):
    ids = spark.range(40)
    frames = {
        "app_train": ids.selectExpr(
            "id AS SK_ID_CURR", "CAST(id % 4 = 0 AS INT) AS TARGET", "-10000 - id AS DAYS_BIRTH",
            "CASE WHEN id % 5 = 0 THEN 365243 ELSE -id END AS DAYS_EMPLOYED", "1000D + id AS AMT_INCOME_TOTAL",
            "2000D + id AS AMT_CREDIT", "CASE WHEN id % 9 = 0 THEN NULL ELSE 10D + id END AS AMT_ANNUITY",
            "id % 12 AS CNT_CHILDREN", "CASE WHEN id % 3 = 0 THEN id END AS OWN_CAR_AGE",
            "CASE WHEN id % 8 = 0 THEN NULL ELSE 'F' END AS CODE_GENDER",
        ),
        "bureau": ids.selectExpr(
            "id AS SK_ID_BUREAU", "id % 10 AS SK_ID_CURR", "100D + id AS AMT_CREDIT_SUM", "50D AS AMT_CREDIT_SUM_DEBT",
            "CASE WHEN id = 3 THEN 7 ELSE -id END AS DAYS_CREDIT", "'Active' AS CREDIT_ACTIVE",
        ),
        "bureau_bal": ids.selectExpr("id AS SK_ID_BUREAU", "-1 AS MONTHS_BALANCE", "CASE WHEN id % 9 = 0 THEN NULL ELSE 'C' END AS STATUS"),
        "prev_app": ids.selectExpr(
            "id AS SK_ID_PREV", "id % 10 AS SK_ID_CURR", "5D AS AMT_APPLICATION", "6D AS AMT_CREDIT",
            "'Approved' AS NAME_CONTRACT_STATUS", "CASE WHEN id % 10 < 7 THEN 365243 ELSE -1 END AS DAYS_FIRST_DRAWING",
        ),
        "pos_cash": ids.selectExpr(
            "id AS SK_ID_PREV", "id % 10 AS SK_ID_CURR", "-1 AS MONTHS_BALANCE", "12D AS CNT_INSTALMENT",
            "'Active' AS NAME_CONTRACT_STATUS",
        ),
        "credit_card": ids.selectExpr(
            "id AS SK_ID_PREV", "id % 3 AS SK_ID_CURR", "9D AS AMT_BALANCE", "100 AS AMT_CREDIT_LIMIT_ACTUAL",
            "CASE WHEN id = 1 THEN NULL ELSE 2 END AS CNT_DRAWINGS_TOTAL",
        ),
        "installments": ids.selectExpr(
            "id AS SK_ID_PREV", "id % 10 AS SK_ID_CURR", "8D AS AMT_INSTALMENT", "IF(id = 2, -1D, 7D) AS AMT_PAYMENT",
            "-5 AS DAYS_INSTALMENT", "-4 AS DAYS_ENTRY_PAYMENT",
        ),
    }
    frames["app_test"] = frames["app_train"].drop("TARGET")
    for name, df in frames.items():
        writers.write_csv(df, f"{root}/{tables.TABLES[name].stem}.csv", "XNA")
    return frames


def test_raw_csv_to_features_and_model(spark, tmp_path):
    """The three jobs of the command line, chained over one registry."""
    raw, clean, final = (str(tmp_path / d) for d in ("raw", "clean", "final"))
    frames = raw_tables(spark, raw)
    # A session that is running is reused by the jobs.
    written = prepare.clean_all(spark, raw, clean)
    assert written == {name: 40 for name in written} and set(written) == set(frames)
    dropped = {"app_train": ("OWN_CAR_AGE",), "prev_app": ("DAYS_FIRST_DRAWING",)}
    shapes = {"app_train": (40, 9), "bureau": (40, 6)}
    found = prepare.verify(spark, clean, dropped=dropped, shapes=shapes)
    assert {r["check"]: r["passed"] for r in checks.verdict(found).collect()}["ALL"]
    cli.main(["features", clean, final, "--strategy", "shuffle"])
    table = spark.read.parquet(final)
    assert table.count() == 40
    assert [r.bureau_loan_count for r in table.where("SK_ID_CURR IN (3, 25)").orderBy("SK_ID_CURR").collect()] == [4, None]
    cli.main(["vectors", f"{clean}/application_train", str(tmp_path / "vectors")])
    assert spark.read.parquet(str(tmp_path / "vectors")).columns == ["SK_ID_CURR", "TARGET", "scaled_features"]
    cli.main(["train", final, str(tmp_path / "models")])
    assert (tmp_path / "models" / "model_RandomForest").exists()


def test_checks_taken_while_writing_are_those_of_the_stored_tables(spark, tmp_path):
    raw, clean = str(tmp_path / "raw"), str(tmp_path / "clean")
    raw_tables(spark, raw)
    found = sorted(map(tuple, prepare.clean_and_check(spark, raw, clean).collect()), key=repr)
    stored = sorted(map(tuple, prepare.verify(spark, clean).where("check <> 'loaded'").collect()), key=repr)
    assert [r for r in found if r[0] != "readable"] == stored
    assert {r[1:] for r in found if r[0] == "readable"} == {("bureau_bal", c, "PASS", 0) for c in ("SK_ID_BUREAU", "MONTHS_BALANCE", "STATUS")}


def test_basic_cleaning_job(spark, tmp_path):
    raw_tables(spark, str(tmp_path))
    cli.main(["clean", f"{tmp_path}/application_train.csv", str(tmp_path / "out")])
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 40
    # This contract has no null token: it stays text, and so does the column it is in.
    assert dict(out.dtypes)["OWN_CAR_AGE"] == "string" and out.where("OWN_CAR_AGE = 'XNA'").count() == 26
    assert out.where("CODE_GENDER IS NULL OR DAYS_EMPLOYED = 365243").count() == 0


def test_default_rollups_match_the_registry():
    assert set(features.default_rollups()) == set(features.SIDES) <= set(tables.TABLES)


def test_supplied_schemas(spark, tmp_path):
    (tmp_path / "bureau.csv").write_text("SK_ID_BUREAU,x\n1,XNA\n2,5\n")
    given = tables.read_raw(spark, str(tmp_path), ["bureau"], schemas={"bureau": "SK_ID_BUREAU BIGINT, x SMALLINT"})["bureau"]
    assert dict(given.dtypes) == {"SK_ID_BUREAU": "bigint", "x": "smallint"}
    assert [r.x for r in given.orderBy("SK_ID_BUREAU").collect()] == [None, 5]


def test_scratch_removes_what_was_staged_in_it(spark):
    with staging.scratch(spark):
        gone = staging.stage(spark.range(3), "gone")
        kept = staging.stage(gone.selectExpr("id + 1 AS id"), "kept", keep=True)
        with staging.scratch(spark):
            inner = staging.stage_all([spark.range(2)], "inner")[0]
        with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|FileNotFound"):
            inner.collect()
        assert gone.count() == 3
    assert sorted(r.id for r in kept.collect()) == [1, 2, 3]
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|FileNotFound"):
        gone.collect()


def test_rejected_cells(spark, tmp_path):
    path = tmp_path / "broken.csv"
    path.write_text("a,b,c\n1,2.5,x\none,2.5,y\n3,,XNA\n,word,z\n5,many,\n7,1\n")
    found = {r["column"]: (r["rejected"], r["rows"]) for r in readers.rejected_cells(spark, str(path), "a INT, b DOUBLE, c STRING", "XNA").collect()}
    assert found == {"a": (1, 6), "b": (2, 6), "c": (0, 6)}
    none = tmp_path / "none.csv"
    none.write_text("a,b,c\n")
    assert {tuple(r) for r in readers.rejected_cells(spark, str(none), "a INT, b DOUBLE, c STRING").collect()} == {(c, 0, 0) for c in "abc"}


def test_metrics_of_a_write_are_those_of_the_rows_written(spark, tmp_path):
    df = spark.newSession().range(0, 1000, 1, 7).selectExpr("id", "nullif(id % 4, 0) AS x")
    seen = writers.write_observed(df, str(tmp_path / "out"), F.count(F.lit(1)).alias("rows"), F.count_if(F.col("x").isNull()).alias("gaps"))
    assert seen == {"rows": 1000, "gaps": 250} and spark.read.parquet(str(tmp_path / "out")).count() == 1000
    assert writers.write_counted(df.limit(0), str(tmp_path / "empty")) == 0
