from __future__ import annotations

import math
import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from loanweave.functions import measures as M
from loanweave.operators import aggregates as A
from loanweave.operators import joins
from loanweave.operators.aggregates import Rollup
from loanweave.plans import features
from loanweave.sources.bucketed import open_bucketed


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_text_mean(spark, rows):
    data = [(1, "C"), (1, "0"), (2, "1"), (2, "3"), (3, "X"), (3, None)]
    df = spark.createDataFrame(data, "SK_ID_BUREAU INT, STATUS STRING").selectExpr("*", "1 AS MONTHS_BALANCE")
    assert rows(A.balance_rollup()(df)) == [(1, 2, 0.0), (2, 2, 2.0), (3, 2, None)]


def test_text_number_equals_a_plain_cast(spark):
    texts = " 1|\t2|+3|-.5|.5|1e3|NaN|nan|Infinity|-inf|inf|0x1p3|1d|2F|C|X|5C||  |\u0663|\x7f5|\x01 6 |--1|a1".split("|")
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "s STRING")
    pairs = df.selectExpr(f"{M.text_number('s')} AS a", "try_cast(s AS DOUBLE) AS b").collect()
    assert [str(r.a) for r in pairs] == [str(r.b) for r in pairs]
    assert sum(r.b is not None for r in pairs) >= 12


def test_bureau_rollup_counts_and_nulls(spark, rows):
    df = spark.createDataFrame(
        [(1, 10, 5.0, None, -3, "Active"), (1, 11, None, None, -5, None), (None, 12, 1.0, 1.0, -1, "Closed")],
        "SK_ID_CURR INT, SK_ID_BUREAU INT, AMT_CREDIT_SUM DOUBLE, AMT_CREDIT_SUM_DEBT DOUBLE, DAYS_CREDIT INT, CREDIT_ACTIVE STRING",
    )
    for scale in (None, 2):
        assert rows(A.bureau_rollup(scale=scale)(df)) == [(None, 1, 1.0, 1.0, -1.0, 0), (1, 2, 5.0, None, -4.0, 1)]


def test_installments_rollup(spark, rows):
    df = spark.createDataFrame(
        [(1, 1, 10.0, 8.0, -5, -3), (1, 1, 10.0, None, -5, None), (1, 1, 10.0, 10.0, -5, -9)],
        "SK_ID_CURR INT, SK_ID_PREV INT, AMT_INSTALMENT DOUBLE, AMT_PAYMENT DOUBLE, DAYS_INSTALMENT INT, DAYS_ENTRY_PAYMENT INT",
    )
    assert rows(A.installments_rollup(scale=2)(df)) == [(1, 3, 1.0, -1.0, 1)]


def test_exact_sum_beyond_one_long(spark):
    df = spark.range(0, 2000, 1, 8).selectExpr("1 AS k", "9.0e13 + id / 100D AS x")
    out = Rollup("k", {"s": M.total("x", 2), "m": M.mean("x", 2)})(df).first()
    exact = 2000 * 9 * 10**13 + (1999 * 2000 // 2) / 100
    assert out.s == exact and out.m == exact / 2000


def test_exact_sum_does_not_depend_on_partitioning(spark):
    base = spark.range(5000).selectExpr("id % 3 AS k", "CAST(id * 7919 % 100003 AS DOUBLE) / 100 AS x")
    roll = Rollup("k", {"s": M.total("x", 2)})
    first = sorted(tuple(r) for r in roll(base.repartition(1)).collect())
    assert first == sorted(tuple(r) for r in roll(base.repartition(13)).collect())


def sides_of(spark):
    one = spark.createDataFrame([(1, 10), (2, 20), (None, 99)], "k INT, a BIGINT")
    two = spark.createDataFrame([(2, "x"), (3, "y")], "k INT, b STRING")
    return [one, two]


BASE = [(1, "p"), (2, "q"), (2, "r"), (4, "s"), (None, "t")]
WANT = Counter([(1, "p", 10, None), (2, "q", 20, "x"), (2, "r", 20, "x"), (4, "s", None, None), (None, "t", None, None)])


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "shuffle"])
@pytest.mark.parametrize("hot", [None, 0.01])
def test_attach_keeps_rows_and_leaves_unmatched_null(spark, strategy, hot):
    base = spark.createDataFrame(BASE, "k INT, v STRING")
    out = joins.attach(base, sides_of(spark), "k", strategy, hot_share=hot)
    assert out.columns == ["k", "v", "a", "b"]
    assert Counter(tuple(r) for r in out.collect()) == WANT


def test_hot_keys_are_found_and_split(spark):
    base = spark.range(30000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 AND id % 2 = 0 THEN NULL ELSE id END AS k", "id"
    )
    assert set(joins.hot_keys(base, "k", 0.01)) == {7, None}
    assert joins.hot_keys(base.where("id < 0"), "k", 0.01) == []
    side = spark.range(40000).selectExpr("id AS k", "id * 2 AS a")
    out = joins.attach(base, [side], "k", "shuffle", hot_share=0.01)
    plan = plan_of(out)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan and "Union" in plan
    assert out.count() == 30000
    assert out.where("k IS NOT NULL AND a = k * 2").count() == out.where("k IS NOT NULL").count()
    assert out.where("k IS NULL AND a IS NULL").count() == 5000


def test_strategy_decides_the_plan(spark):
    base = spark.range(100).withColumnRenamed("id", "k")
    sides = [Rollup("k", {f"n{i}": "count(1)"})(spark.range(500).selectExpr("id % 100 AS k")) for i in range(5)]
    shuffled = plan_of(joins.attach(base, sides, "k", "shuffle"))
    assert shuffled.count("SortMergeJoin") == 5 and "BroadcastHashJoin" not in shuffled
    # Base once, and each roll-up once for its own grouping.
    assert shuffled.count("Exchange hashpartitioning") == 6
    checked = plan_of(joins.attach(base, sides, "k", "broadcast"))
    assert checked.count("BroadcastHashJoin") == 5 and "hashpartitioning" not in checked
    too_big = plan_of(joins.attach(base, sides, "k", "broadcast", limit=100))
    assert too_big.count("SortMergeJoin") == 5 and "BroadcastHashJoin" not in too_big


def test_left_join_checks_the_size(spark):
    base, side = spark.range(10), spark.range(10).selectExpr("id", "repeat('x', 100) AS s")
    assert "BroadcastHashJoin" in plan_of(joins.left_join(base, side, "id", "broadcast"))
    assert "SortMergeJoin" in plan_of(joins.left_join(base, side, "id", "broadcast", limit=1000))
    with pytest.raises(ValueError):
        joins.left_join(base, side, "id", "other")


def test_second_level_balance(spark, rows):
    bureau = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "SK_ID_CURR INT, SK_ID_BUREAU INT")
    balance = spark.createDataFrame(
        [(10, -1, "1"), (10, -2, "3"), (11, -1, "C"), (11, -2, "2")],
        "SK_ID_BUREAU INT, MONTHS_BALANCE INT, STATUS STRING",
    )
    assert rows(features.balance_features(bureau, balance)) == [(1, 2, 2, 4, 2.0), (2, 1, 0, None, None)]
    assert rows(features.loans_with_balance(bureau, balance)) == [(10, 1, 2, 2.0), (11, 1, 2, 2.0), (12, 2, None, None)]


def test_compare_strategies(spark):
    base = spark.range(50).withColumnRenamed("id", "k")
    out = features.compare_strategies(base, [base.selectExpr("k", "k AS a")], "k").collect()
    assert [(r.strategy, r.rows) for r in out] == [("shuffle", 50), ("broadcast", 50)]
    assert out[0].speedup == 1.0 and all(r.seconds > 0 for r in out)


def test_final_features_with_balance(spark):
    ids = spark.range(6)
    tables = {
        "app_train": ids.selectExpr("id AS SK_ID_CURR"),
        "bureau": ids.selectExpr(
            "id % 2 AS SK_ID_CURR", "id AS SK_ID_BUREAU", "1D AS AMT_CREDIT_SUM", "1D AS AMT_CREDIT_SUM_DEBT",
            "-1 AS DAYS_CREDIT", "'Active' AS CREDIT_ACTIVE",
        ),
        "bureau_bal": ids.selectExpr("id AS SK_ID_BUREAU", "-1 AS MONTHS_BALANCE", "CAST(id AS STRING) AS STATUS"),
    }
    plain = features.final_features(tables, {"bureau": A.bureau_rollup()})
    both = features.final_features(tables, {"bureau": A.bureau_rollup()}, with_balance=True)
    assert set(both.columns) - set(plain.columns) == {"bb_loans", "bb_loans_with_history", "bb_months_total", "bb_avg_status"}
    got = {r.SK_ID_CURR: (r.bureau_loan_count, r.bb_avg_status) for r in both.collect()}
    assert got[0] == (3, 2.0) and got[1] == (3, 3.0) and got[2] == (None, None)


@pytest.mark.parametrize("values,scale", [([0.005, 0.005], 2), ([1e18], 2), ([float("nan")], 0)])
def test_exact_sum_refuses_what_it_would_round(spark, values, scale):
    df = spark.createDataFrame([(1, v) for v in values], "k INT, x DOUBLE")
    with pytest.raises(Exception, match="exact to|CAST_OVERFLOW"):
        Rollup("k", {"s": M.total("x", scale)})(df).collect()


def test_exact_sum_takes_null_and_stored_decimals(spark):
    df = spark.createDataFrame([(1, 0.29), (1, None), (1, 1234567.89), (2, None)], "k INT, x DOUBLE")
    assert sorted(tuple(r) for r in Rollup("k", {"s": M.total("x", 2)})(df).collect()) == [(1, 1234568.18), (2, None)]


@pytest.mark.parametrize("limit", [0, joins.BROADCAST_LIMIT])
def test_a_repeated_side_key_repeats_hot_rows(spark, limit):
    base = spark.range(3000).selectExpr("IF(id % 2 = 0, 5, IF(id % 5 = 0, NULL, id)) AS k", "id AS salt")
    twice = spark.createDataFrame([(5, 1), (5, 2), (7, 3), (None, 4)], "k BIGINT, a INT")
    out = joins.attach(base, [twice], "k", "shuffle", limit=limit, hot_share=0.1)
    assert out.columns == ["k", "salt", "a"]
    want = base.join(twice, "k", "left")
    assert Counter(tuple(r) for r in out.collect()) == Counter(tuple(r) for r in want.collect())


def test_salted_rows_of_one_key_go_to_many_tasks(spark):
    base = spark.range(6400).selectExpr("1 AS k", "id")
    side = spark.createDataFrame([(1, "a"), (1, "b")], "k INT, v STRING")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = joins.salted_join(base, side, "k", 8)
        sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 12800 and len(sizes) > 1


def test_bucketed_inputs_join_without_an_exchange(spark, tmp_path):
    tables = {
        "base": spark.range(100).selectExpr("id AS k", "id % 3 AS v"),
        "a": spark.range(300).selectExpr("id % 120 AS k", "id AS x"),
        "b": spark.range(50).selectExpr("id * 2 AS k", "id AS x"),
    }
    rollups = {n: Rollup("k", {f"{n}_sum": "sum(x)"}) for n in ("a", "b")}
    base, sides = features.bucketed_inputs(tables, str(tmp_path), rollups, "base", "k", 4)
    out = joins.attach(base, sides, "k", "shuffle")
    plan = plan_of(out)
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan
    want = joins.attach(tables["base"], [rollups[n](tables[n]) for n in ("a", "b")], "k")
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    again = open_bucketed(spark, "again", f"{tmp_path}/base", tables["base"].schema, "k", 4)
    assert "Exchange" not in plan_of(joins.attach(again, sides, "k", "shuffle")) and again.count() == 100


@pytest.mark.parametrize("values", [
    [1e16, 1.0, -1e16, 0.1], [0.1] * 10, [-0.1, -0.2, 0.3], [2.0**63, 1.5, -(2.0**63)], [1e-18, 3.0], [123.45, -7.0, None], [5e-324, -1.0],
])
def test_binned_sums_are_exact_in_any_order(spark, values):
    sums = set()
    for seed in range(3):
        rows = [(1, v) for v in values]
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k INT, x DOUBLE").repartition(seed + 1)
        sums.add(tuple(Rollup("k", {"s": M.total("x", M.ANY), "m": M.mean("x", M.ANY)})(df).first()))
    (k, total, mean), = sums
    cut = [Fraction(math.trunc(Fraction(v) * 2**66), 2**66) for v in values if v is not None]
    assert abs(Fraction(total) - sum(cut)) <= abs(sum(cut)) * Fraction(1, 2**51)
    assert mean == total / len(cut)


def test_binned_sums_of_nothing_and_of_odd_values(spark):
    rows = [(1, None), (2, float("inf")), (2, 1.0), (3, float("nan")), (4, 1e300), (4, 2.0)]
    df = spark.createDataFrame(rows, "k INT, x DOUBLE")
    found = {r["k"]: r["s"] for r in Rollup("k", {"s": M.total("x", M.ANY)})(df).collect()}
    assert found[1] is None and found[2] == math.inf and math.isnan(found[3]) and found[4] == 1e300


def test_splitting_computes_sides_once(spark):
    base = spark.range(3000).selectExpr("IF(id % 2 = 0, 5, id) AS k")
    side = Rollup("k", {"n": "count(1)"})(spark.range(9000).selectExpr("id % 3000 AS k"))
    plan = plan_of(joins.attach(base, [side], "k", "shuffle", hot_share=0.1))
    assert "HashAggregate" not in plan and "Union" in plan  # the stored roll-up is scanned, not computed again


def test_stored_sides_are_not_staged_again(spark):
    base = spark.range(10).withColumnRenamed("id", "k")
    stored = joins.stage_all([spark.range(10).selectExpr("id AS k", "'x' AS a")], "side")
    assert joins.stage_all(stored, "side")[0] is stored[0]
    assert joins.measured_bytes(stored[0]) == 10 * (32 + 16) + 10
    assert joins.attach(base, stored, "k", "broadcast").count() == 10
