"""Verification of cleaned tables as rows ``(check, table, subject, status, detail)``.

``detail`` is the count that a check looked at. Status is PASS, FAIL, WARN or SKIP; the
verdict is that nothing failed. A check is a list of SQL structs over aggregates, so all
checks of one table share a single scan (``run``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanweave.functions.expressions import quoted, text
from loanweave.operators.profile import SENTINEL, nulls_in
from loanweave.sources.writers import write_observed

SCHEMA = "check STRING, table STRING, subject STRING, status STRING, detail BIGINT"


def _cell(check: str, subject: str, status: str, detail: str) -> str:
    return (
        f"named_struct('check', '{check}', 'subject', {subject}, 'status', {status},"
        f" 'detail', CAST({detail} AS BIGINT))"
    )


def _passed(condition: str, otherwise: str = "FAIL") -> str:
    return f"CASE WHEN {condition} THEN 'PASS' ELSE '{otherwise}' END"


def run(df: DataFrame, table: str, *checks: Sequence[str]) -> DataFrame:
    """All checks of a table from one aggregate."""
    cells = [cell for check in checks for cell in check]
    return (
        df.selectExpr(f"array({', '.join(cells)}) AS cells")
        .select(F.inline("cells"))
        .select("check", F.lit(table).alias("table"), "subject", "status", "detail")
    )


def on_write(df: DataFrame, path: str, table: str, *checks: Sequence[str]) -> DataFrame:
    """All checks of a table, taken while it is written to ``path``; nothing is read back. See
    ``write_observed`` for the session that ``df`` should belong to."""
    cells = [cell for check in checks for cell in check]
    found = write_observed(df, path, F.expr(f"array({', '.join(cells)})").alias("cells"))["cells"]
    rows = [(c["check"], table, c["subject"], c["status"], c["detail"]) for c in found]
    return df.sparkSession.createDataFrame(rows, SCHEMA)


def loaded(spark: SparkSession, expected: Sequence[str], missing: Iterable[str]) -> DataFrame:
    """Every expected table could be read."""
    gone = set(missing)
    rows = [("loaded", t, "*", "FAIL" if t in gone else "PASS", int(t not in gone)) for t in expected]
    return spark.createDataFrame(rows, SCHEMA)


def cells_readable(found: DataFrame, table: str) -> DataFrame:
    """Rows of ``rejected_cells``: does a column's declared type read all its cells? A loss is a warning."""
    status = F.when(F.col("rejected") == 0, "PASS").otherwise("WARN")
    return found.select(
        F.lit("readable").alias("check"), F.lit(table).alias("table"), F.col("column").alias("subject"), status.alias("status"), F.col("rejected").alias("detail")
    )


def sentinel_gone(df: DataFrame, columns: Sequence[str], value: int = SENTINEL) -> list[str]:
    """No marker value is left; columns that the table lacks are skipped."""
    cells = []
    for c in columns:
        hits = f"count_if({quoted(c)} = {value})"
        if c in df.columns:
            cells.append(_cell("sentinel_gone", text(c), _passed(f"{hits} = 0"), hits))
        else:
            cells.append(_cell("sentinel_gone", text(c), "'SKIP'", "NULL"))
    return cells


def remaining_nulls(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """NULLs left in the repaired columns, for information."""
    return [_cell("remaining_nulls", text(c), "'PASS'", nulls_in(c)) for c in columns if c in df.columns]


def days_not_positive(columns: Sequence[str], hard: Iterable[str] = ()) -> list[str]:
    """Day offsets are not positive; a violation fails only for the ``hard`` columns."""
    strict, cells = set(hard), []
    for c in columns:
        hits = f"count_if({quoted(c)} > 0)"
        status = _passed(f"{hits} = 0", "FAIL" if c in strict else "WARN")
        cells.append(_cell("days_not_positive", text(c), status, hits))
    return cells


def columns_dropped(df: DataFrame, expected: Sequence[str]) -> list[str]:
    """None of the columns that should be gone is present."""
    here = set(df.columns)
    return [
        _cell("dropped", text(c), "'FAIL'" if c in here else "'PASS'", str(int(c in here))) for c in expected
    ]


def expected_shape(df: DataFrame, rows: int, cols: int) -> list[str]:
    """Row count and column count as expected."""
    ok = f"count(1) = {rows} AND {len(df.columns)} = {cols}"
    return [_cell("shape", f"'{rows} x {cols}'", _passed(ok), "count(1)")]


def nulls_acceptable(df: DataFrame, acceptable: bool) -> list[str]:
    """The table is free of NULLs, unless some are accepted; the subject says which."""
    nulls = "(" + " + ".join(nulls_in(c) for c in df.columns) + ")"
    state = f"CASE WHEN {nulls} = 0 THEN 'clean' ELSE '{'acceptable' if acceptable else 'review'}' END"
    return [_cell("nulls", state, "'PASS'" if acceptable else _passed(f"{nulls} = 0"), nulls)]


def combine(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def verdict(checks: DataFrame) -> DataFrame:
    """One row per check and one, ``ALL``, over everything: did nothing fail?"""
    passed = F.coalesce(F.bool_and(F.col("status") != "FAIL"), F.lit(True)).alias("passed")
    counted = [F.count(F.lit(1)).alias("checked"), F.count_if(F.col("status") == "FAIL").alias("failed"), passed]
    each = checks.groupBy("check").agg(*counted)
    return each.unionByName(each.agg(
        F.lit("ALL").alias("check"),
        F.coalesce(F.sum("checked"), F.lit(0)).alias("checked"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("failed"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed"),
    ))
