from __future__ import annotations

from pyspark.sql import functions as F

from loanweave.operators import checks, profile
from loanweave.operators.modes import candidates, frequent_mode_table, mode_table


def test_missing_report(spark):
    data = [(i, None if i < 7 else 1.0, None if i < 2 else "a", None if i < 3 else 1) for i in range(10)]
    df = spark.createDataFrame(data, "k INT, d DOUBLE, s STRING, n INT")
    assert [tuple(r) for r in profile.missing_report(df).collect()] == [
        ("d", "double", 7, 70.0, "DROP column (>60%)"),
        ("n", "int", 3, 30.0, "Fill MEDIAN"),
        ("s", "string", 2, 20.0, "Fill MODE"),
    ]


def test_last_step_gets_as_many_rows_for_any_number_of_tasks(spark):
    """The tasks' partial rows are combined in a fixed number of groups before the last step."""
    for tasks in (4, 400):
        df = spark.range(0, 4000, 1, tasks).selectExpr("id", "nullif(id % 5, 0) AS x")
        groups = profile.by_group(df, F.count("x").alias("n"))
        assert groups.count() == min(tasks, profile.GROUPS)
        assert sorted(tuple(r) for r in profile.null_counts(df).collect()) == [("id", "bigint", 4000, 0), ("x", "bigint", 4000, 800)]
        plan = profile.null_counts(df)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2 and "Exchange SinglePartition" not in plan
    assert [tuple(r) for r in profile.null_counts(df.where("id < 0")).orderBy("column").collect()] == [("id", "bigint", 0, 0), ("x", "bigint", 0, 0)]


def test_modes_by_candidates(spark):
    data = "id % 7 = 0 AS often", "id", "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 10 < 4 THEN 'b' ELSE string(id) END AS s", "'' AS e"
    df = spark.range(30000).selectExpr(*data, "string(id) AS own", "IF(id % 2 = 0, 'x', 'w') AS tie", "string(NULL) AS none").drop("often")
    names = ["s", "e", "own", "tie", "none"]
    both = [sorted(map(tuple, f(df, names).collect()), key=repr) for f in (mode_table, frequent_mode_table)]
    assert both[0] == both[1] and len(both[0]) == 5
    found, others, rows = candidates(df, names)
    assert rows == 30000 and max(others.values()) < 100 and all(len(v) <= 64 for v in found.values())
    assert frequent_mode_table(df.limit(0), names).count() == 0


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, None)], "`a.b` INT, `it's``x` INT")
    assert {r["column"]: r["nulls"] for r in profile.null_counts(df).collect()} == {"a.b": 0, "it's`x": 1}


def test_hits_and_ranges(spark, rows):
    df = spark.createDataFrame(
        [(365243, 1, 2.5, None), (-1, -1, -3.0, None), (None, 0, 1.0, None)],
        "DAYS_A INT, DAYS_B INT, AMT_A DOUBLE, AMT_B DOUBLE",
    )
    days = ["DAYS_A", "DAYS_B"]
    assert [tuple(r)[:3] for r in profile.sentinel_counts(df, days).collect()] == [("DAYS_A", 1, 3)]
    assert rows(profile.positive_counts(df, days).select("column", "hits")) == [("DAYS_A", 1), ("DAYS_B", 1)]
    assert rows(profile.negative_counts(df, ["AMT_A", "AMT_B"], keep_zero=True).select("hits")) == [(0,), (1,)]
    ranges = [tuple(r) for r in profile.amount_ranges(df, ["AMT_A", "AMT_B"], scale=2).collect()]
    assert ranges == [("AMT_A", -3.0, 2.5, 0.5 / 3)]
    assert profile.sentinel_counts(df, []).collect() == []


def test_summaries(spark):
    raw = {"a": spark.createDataFrame([(1, None), (None, None)], "x INT, y INT"), "b": spark.range(3)}
    clean = {"a": spark.createDataFrame([(1, 0), (2, None)], "x INT, y INT"), "b": spark.range(3)}
    assert [tuple(r) for r in profile.table_summary(raw).orderBy("table").collect()] == [("a", 2, 2, 3), ("b", 3, 1, 0)]
    cells = {r["table"]: (r["pct"], r["status"]) for r in profile.null_cells(raw, ["b"]).collect()}
    assert cells == {"a": (75.0, "review"), "b": (0.0, "clean")}
    reduced = {r["table"]: (r["removed"], r["removed_pct"]) for r in profile.null_reduction(raw, clean).collect()}
    assert reduced == {"a": (2, 2 / 3 * 100), "b": (0, 0.0)}
    assert [tuple(r) for r in profile.top_null_columns(raw["a"], 1).collect()] == [("y", 2)]


def test_mode_table(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", "z")], "s STRING, t STRING")
    assert {tuple(r) for r in mode_table(df, ["s", "t"]).collect()} == {("s", "a", 2), ("t", None, 2)}


def test_checks_and_verdict(spark):
    df = spark.createDataFrame([(365243, 4, None), (-2, 0, 1)], "DAYS_EMPLOYED INT, DAYS_X INT, a INT")
    found = checks.combine(
        checks.loaded(spark, ["t", "u"], ["u"]),
        checks.run(
            df,
            "t",
            checks.sentinel_gone(df, ["DAYS_EMPLOYED", "DAYS_GONE"]),
            checks.days_not_positive(["DAYS_EMPLOYED", "DAYS_X"], ["DAYS_EMPLOYED"]),
            checks.columns_dropped(df, ["a", "b"]),
            checks.expected_shape(df, 2, 3),
            checks.nulls_acceptable(df, False),
            checks.remaining_nulls(df, ["a"]),
        ),
    )
    got = {(r["check"], r["table"], r["subject"]): (r["status"], r["detail"]) for r in found.collect()}
    assert got == {
        ("loaded", "t", "*"): ("PASS", 1),
        ("loaded", "u", "*"): ("FAIL", 0),
        ("sentinel_gone", "t", "DAYS_EMPLOYED"): ("FAIL", 1),
        ("sentinel_gone", "t", "DAYS_GONE"): ("SKIP", None),
        ("days_not_positive", "t", "DAYS_EMPLOYED"): ("FAIL", 1),
        ("days_not_positive", "t", "DAYS_X"): ("WARN", 1),
        ("dropped", "t", "a"): ("FAIL", 1),
        ("dropped", "t", "b"): ("PASS", 0),
        ("shape", "t", "2 x 3"): ("PASS", 2),
        ("nulls", "t", "review"): ("FAIL", 1),
        ("remaining_nulls", "t", "a"): ("PASS", 1),
    }
    passed = {r["check"]: r["passed"] for r in checks.verdict(found).collect()}
    assert passed["ALL"] is False and passed["shape"] is True and passed["dropped"] is False


def test_checks_of_a_table_share_one_scan(spark, tmp_path):
    spark.range(10).selectExpr("id AS DAYS_A", "id AS b").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = checks.run(df, "t", checks.days_not_positive(["DAYS_A"]), checks.nulls_acceptable(df, True))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_checks_take_odd_names(spark):
    df = spark.createDataFrame([(1, None)], "`it's` INT, `b\\\\c` INT")
    names = df.columns
    found = checks.run(
        df, "it's", checks.sentinel_gone(df, names), checks.days_not_positive(names), checks.columns_dropped(df, ["no'ne"]),
        checks.remaining_nulls(df, names),
    ).collect()
    assert {r.subject for r in found} == {*names, "no'ne"} and {r.table for r in found} == {"it's"}


def test_reports_over_tables(spark):
    df = spark.createDataFrame([(1, None)], "DAYS_A INT, DAYS_B INT")
    out = profile.over_tables({"a": df, "b": df}, lambda d: profile.positive_counts(d, d.columns)).collect()
    assert [(r.table, r["column"], r.hits) for r in out] == [("a", "DAYS_A", 1), ("b", "DAYS_A", 1)]
