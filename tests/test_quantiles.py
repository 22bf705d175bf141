from __future__ import annotations

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from loanweave.operators import quantiles as Q
from loanweave.operators.quantiles import quantiles, rank_of

PS = [0.25, 0.5, 0.75]


def brute(values, p):
    kept = sorted(v for v in values if v is not None and not math.isnan(v))
    return kept[rank_of(p, len(kept)) - 1] if kept else None


def frame(spark, *columns):
    names = [f"c{i}" for i in range(len(columns))]
    schema = ", ".join(f"{n} DOUBLE" for n in names)
    return spark.createDataFrame(list(zip(*columns)), schema), names


@pytest.mark.parametrize(
    "values",
    [
        [1.0, 2.0, 3.0, 4.0, None],
        [7.0],
        [None, None],
        [3.0, 3.0, 3.0, float("nan")],
        [float("-inf"), 1.0, 2.0, float("inf"), float("inf")],
        [float("inf"), float("inf"), None],
        [-1.7e308, 0.0, 1.0, 2.0, 1.7e308],
        [0.0, 5e-324, 1e-323, 1.0, 1e300],
    ],
)
def test_edges(spark, values):
    df, _ = frame(spark, values)
    assert quantiles(df, {"c0": PS})["c0"] == [brute(values, p) for p in PS]


def test_many_rounds_and_columns(spark):
    random.seed(1)
    skewed = [math.exp(random.gauss(0, 6)) for _ in range(20000)] + [1e12]
    hot = [5.0 if i % 3 == 0 else random.random() * 1e6 for i in range(20001)]
    gaps = [None if i % 4 else float(i % 700) for i in range(20001)]
    df, names = frame(spark, skewed, hot, gaps)
    found = quantiles(df.repartition(7), {n: PS for n in names})
    for name, values in zip(names, (skewed, hot, gaps)):
        assert found[name] == [brute(values, p) for p in PS]


def test_tolerated_error_stays_within_rank(spark):
    random.seed(2)
    values = [random.lognormvariate(0, 3) for _ in range(10000)]
    df, _ = frame(spark, values)
    ordered = sorted(values)
    for p, value in zip(PS, quantiles(df, {"c0": PS}, rel_error=0.01)["c0"]):
        assert abs(ordered.index(value) + 1 - rank_of(p, 10000)) <= 100


def test_integer_and_expression(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(1, 5)], "a INT, b INT")
    assert quantiles(df, {"a": [0.5]}) == {"a": [2.0]}
    assert quantiles(df, {"x": [1.0]}, values={"x": "a * 10"}) == {"x": [40.0]}
    assert quantiles(df, {"a": []}) == {"a": []}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(allow_nan=True)), min_size=1, max_size=40))
def test_property(spark, values):
    df, _ = frame(spark, values)
    for got, p in zip(quantiles(df, {"c0": PS})["c0"], PS):
        assert got == brute(values, p)


def test_sketches_are_within_the_rank_error(spark):
    df = spark.range(20000).selectExpr("CAST(id * 7919 % 20011 AS DOUBLE) AS a", "IF(id % 3 = 0, NULL, id * id) AS b")
    wanted = {"a": [1, 5000, 10000, 20000], "b": [100, 6000]}
    row = df.selectExpr("count(a) AS na", "min(a) AS la", "max(a) AS ua", "count(b) AS nb", "min(b) AS lb", "max(b) AS ub").first()
    extents = {c: Q.Extent(row[f"n{c}"], row[f"l{c}"], row[f"u{c}"]) for c in "ab"}
    values = {"a": "`a`", "b": "`b`"}
    found = Q.order_statistics(df, values, wanted, extents, 0.001, sketch=True)
    for (c, rank), value in found.items():
        below = df.where(f"{c} < {value}").count()
        upto = df.where(f"{c} <= {value}").count()
        assert upto >= rank - 0.002 * extents[c].n and below <= rank + 0.002 * extents[c].n
    with pytest.raises(ValueError, match="rank error"):
        Q.order_statistics(df, values, wanted, extents, 0.0, sketch=True)
