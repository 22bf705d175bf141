"""Data-quality profiles.

Each profile is a lazy DataFrame: one scan and one output row per column. The partial
results, a single small row per task, are combined in ``GROUPS`` groups first, so that the
last step gets a fixed number of rows however many tasks scan the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanweave.functions.expressions import quoted, text
from loanweave.functions import measures as M
from loanweave.functions.roles import numeric_columns

SENTINEL = 365243
GROUPS = 64
# How the results of an aggregate are combined.
_COMBINE = {"count": "sum", "count_if": "sum", "sum": "sum", "min": "min", "max": "max", "kll_sketch_agg_double": "kll_merge_agg_double"}


def by_group(df: DataFrame, *aggregates: Column) -> DataFrame:
    """The aggregates of at most ``GROUPS`` groups of scan tasks."""
    return df.groupBy(F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("group")).agg(*aggregates).drop("group")


def per_column(
    df: DataFrame, columns: Sequence[str], stats: Callable[[str], Mapping[str, str]]
) -> DataFrame:
    """Rows ``(column, type, rows, *stats)``; ``stats`` gives SQL aggregates for a column name,
    each one call of a function whose results can be combined (count, sum, min, max, sketch)."""
    types = dict(df.dtypes)
    names = list(columns) or df.columns[:1]
    cells, combined = [], {}
    for i, name in enumerate(names):
        fields = {"rows": "count(1)", **stats(name)}
        cells.append(f"named_struct('cell', {i}, " + ", ".join(f"'{k}', {sql}" for k, sql in fields.items()) + ")")
        for k, sql in fields.items():
            combined[k] = _COMBINE[sql.partition("(")[0]]
    groups = by_group(df, F.expr(f"array({', '.join(cells)})").alias("cells")).select(F.inline("cells"))
    # a row for each column even if there is no row to count
    kinds = {f.name: f.dataType for f in groups.schema}
    none = [F.lit(0 if f == "sum" else None).cast(kinds[k]).alias(k) for k, f in combined.items()]
    every = df.sparkSession.range(len(names), numPartitions=1).select(F.col("id").cast("int").alias("cell"), *none)
    out = groups.unionByName(every).groupBy("cell").agg(*[F.expr(f"{f}({quoted(k)})").alias(k) for k, f in combined.items()])
    label = F.array(*[F.struct(F.lit(n).alias("column"), F.lit(types[n]).alias("type")) for n in names])
    out = out.select(F.get(label, "cell").alias("label"), *combined).select("label.*", *combined)
    return out if columns else out.where(F.lit(False))


def nulls_in(name: str) -> str:
    return f"count_if({quoted(name)} IS NULL)"


def null_counts(df: DataFrame) -> DataFrame:
    """``(column, type, rows, nulls)`` for every column."""
    return per_column(df, df.columns, lambda c: {"nulls": nulls_in(c)})


def missing_report(df: DataFrame, drop_above: float = 60.0) -> DataFrame:
    """Columns with NULLs, worst first, with the proposed treatment."""
    numeric = numeric_columns(df.schema)
    # The names of the treatments.
    pct = F.round(F.col("nulls") / F.col("rows") * 100, 2)
    strategy = (
        F.when(F.col("pct") > drop_above, "DROP column (>60%)" if drop_above == 60 else "DROP column")
        .when(F.col("column").isin(numeric), "Fill MEDIAN")
        .otherwise("Fill MODE")
    )
    return (
        null_counts(df)
        .where("nulls > 0")
        .withColumn("pct", pct)
        .select("column", "type", "nulls", "pct", strategy.alias("strategy"))
        .orderBy(F.desc("pct"), "column")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency table of one column, most frequent first."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc_nulls_last(column))
    )


def _hits(df: DataFrame, columns: Sequence[str], test: str, keep_zero: bool) -> DataFrame:
    out = per_column(df, columns, lambda c: {"hits": f"count_if({quoted(c)} {test})"}).selectExpr(
        "column", "hits", "rows", "try_divide(hits * 100D, rows) AS pct"
    )
    return out if keep_zero else out.where("hits > 0")


def sentinel_counts(
    df: DataFrame, columns: Sequence[str], value: int = SENTINEL, keep_zero: bool = False
) -> DataFrame:
    return _hits(df, columns, f"= {value}", keep_zero)


def positive_counts(df: DataFrame, columns: Sequence[str], keep_zero: bool = False) -> DataFrame:
    return _hits(df, columns, "> 0", keep_zero)


def negative_counts(df: DataFrame, columns: Sequence[str], keep_zero: bool = False) -> DataFrame:
    return _hits(df, columns, "< 0", keep_zero)


def amount_ranges(df: DataFrame, columns: Sequence[str], scale: M.Scale = M.ANY) -> DataFrame:
    """``(column, min, max, mean)``; a column without any value gives no row."""

    def stats(c: str) -> dict[str, str]:
        number = f"CAST({quoted(c)} AS DOUBLE)"
        parts = {f"part{i}": sql for i, sql in enumerate(M.sum_parts(c, scale))}
        return {"min": f"min({number})", "max": f"max({number})", "n": M.count(c), **parts}

    out = per_column(df, columns, stats).where("n > 0")
    parts = [c for c in out.columns if c.startswith("part")]
    return out.select("column", "min", "max", F.expr(f"CAST({M.sum_of(parts, 'n', scale)} AS DOUBLE) / n").alias("mean"))


def _summary_row(name: str, df: DataFrame) -> DataFrame:
    nulls = F.expr(" + ".join(nulls_in(c) for c in df.columns)).alias("nulls")
    return by_group(df, F.count(F.lit(1)).alias("rows"), nulls).agg(
        F.lit(name).alias("table"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.lit(len(df.columns)).alias("cols"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("nulls"),
    )


def over_tables(tables: Mapping[str, DataFrame], report: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A report of several tables, with a leading ``table`` column."""
    parts = [report(df).select(F.lit(name).alias("table"), "*") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def table_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table, rows, cols, nulls)``, one row per table."""
    return reduce(DataFrame.unionByName, [_summary_row(n, d) for n, d in tables.items()])


def null_cells(tables: Mapping[str, DataFrame], acceptable: Iterable[str] = ()) -> DataFrame:
    """Table summary with the share of NULL cells and a status."""
    cells = F.col("rows") * F.col("cols")
    status = (
        F.when(F.col("nulls") == 0, "clean")
        .when(F.col("table").isin(*acceptable), "acceptable")
        .otherwise("review")
    )
    pct = F.coalesce(F.try_divide(F.col("nulls"), cells) * 100, F.lit(0.0))
    return table_summary(tables).withColumns({"pct": pct, "status": status})


def top_null_columns(df: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` columns with most NULLs."""
    return (
        null_counts(df)
        .where("nulls > 0")
        .orderBy(F.desc("nulls"), "column")
        .limit(n)
        .select("column", "nulls")
    )


def null_reduction(raw: Mapping[str, DataFrame], clean: Mapping[str, DataFrame]) -> DataFrame:
    """NULL cells before and after cleaning, for the tables present on both sides."""
    both = [t for t in raw if t in clean]
    before = table_summary({t: raw[t] for t in both}).select("table", F.col("nulls").alias("raw_nulls"))
    after = table_summary({t: clean[t] for t in both}).select("table", F.col("nulls").alias("clean_nulls"))
    removed = F.col("raw_nulls") - F.col("clean_nulls")
    pct = F.when(F.col("raw_nulls") > 0, removed / F.col("raw_nulls") * 100).otherwise(0.0)
    return before.join(after, "table").withColumns({"removed": removed, "removed_pct": pct})
