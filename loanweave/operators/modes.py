"""Most frequent value of several text columns.

``mode_table`` counts all values, in one job; it shuffles every distinct value of a column.
``frequent_mode_table`` suits columns of very many values: a bounded sketch proposes
candidates, a second scan counts only these, exactly, and the result stands if the best of
them is more frequent than anything that the sketch can have missed. Columns where that
cannot be shown are counted in full.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanweave.functions.expressions import quoted
from loanweave.operators.profile import by_group

#: Entries of a sketch, and candidates that it proposes.
TRACKED, CANDIDATES = 4096, 64
# A sketch of m entries is wrong by at most 3.5 n / m for n rows, where it keeps m = TRACKED / 0.75
# at least. It may hold back an entry whose lower bound is within that error.
_MISSED = 2 * 3.5 * 0.75 / TRACKED


def _pairs(columns: Sequence[str]) -> Column:
    return F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(quoted(c)).alias("value")) for c in columns]))


def mode_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``(column, value, n)``.

    NULL competes like any value; ties go to the smallest value, NULL last. Counts are
    combined per task before the shuffle, so a value that fills a third of the table
    costs no more than a rare one.
    """
    return (
        df.select(_pairs(columns))
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("column")
        .agg(F.min(F.struct((-F.col("n")).alias("less"), F.col("value").isNull().alias("absent"), "value")).alias("top"))
        .select("column", "top.value", (-F.col("top.less")).alias("n"))
    )


def candidates(df: DataFrame, columns: Sequence[str]) -> tuple[dict[str, list], dict[str, float], int]:
    """Per column at most ``CANDIDATES`` values, the largest count that any other value can have,
    and the number of rows. One scan; sketches are merged in groups first."""
    sketches = [F.expr(f"approx_top_k_accumulate({quoted(c)}, {TRACKED})").alias(f"s{i}") for i, c in enumerate(columns)]
    merged = [F.expr(f"approx_top_k_combine(s{i}, {TRACKED})").alias(f"s{i}") for i in range(len(columns))]
    read = [F.expr(f"approx_top_k_estimate(s{i}, {CANDIDATES})").alias(f"s{i}") for i in range(len(columns))]
    row = by_group(df, *sketches, F.count(F.lit(1)).alias("n")).agg(*merged, F.sum("n").alias("n")).select(*read, "n").first()
    found = {c: [(item["item"], item["count"]) for item in row[f"s{i}"]] for i, c in enumerate(columns)}
    others = {c: max([_MISSED * row["n"], *[n for _, n in top[CANDIDATES - 1 :]]]) for c, top in found.items()}
    return {c: [value for value, _ in top] for c, top in found.items()}, others, row["n"]


def frequent_mode_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """As ``mode_table``, exact as well, without shuffling the rare values of a column."""
    spark = df.sparkSession
    if df.isEmpty():  # a sketch of nothing cannot be read
        return mode_table(df, columns)
    proposed, others, _ = candidates(df, columns)
    rows = [(c, value) for c, values in proposed.items() for value in values]
    wanted = F.broadcast(spark.createDataFrame(rows, "c STRING, v STRING"))
    same = (F.col("column") == F.col("c")) & F.col("value").eqNullSafe(F.col("v"))
    counted = df.select(_pairs(columns)).join(wanted, same).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")).collect()
    best = {}
    for r in counted:
        order = (-r["n"], r["value"] is None, (r["value"] or "").encode())
        best[r["column"]] = min(best.get(r["column"], (order, r)), (order, r), key=lambda x: x[0])
    proven = [tuple(r) for c, (_, r) in best.items() if r["n"] > others[c]]
    rest = [c for c in columns if c not in {c for c, _, _ in proven}]
    out = spark.createDataFrame(proven, "column STRING, value STRING, n BIGINT")
    return out.unionByName(mode_table(df, rest)) if rest else out


def modes(df: DataFrame, columns: Sequence[str], by_candidates: bool = False) -> dict[str, str]:
    """Usable fill value per column; columns whose mode is NULL or empty are left out."""
    if not columns:
        return {}
    table = frequent_mode_table if by_candidates else mode_table
    return {r["column"]: r["value"] for r in table(df, columns).collect() if r["value"]}
