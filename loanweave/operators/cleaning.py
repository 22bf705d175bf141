"""Declarative table cleaning: a spec is fitted once, then applied lazily.

Which columns survive and what fills them depends on the data, so ``fit`` is eager. It
makes one scan that counts NULLs and bounds of all columns, one or two counting rounds
over the columns that need a median or fences, and one scan for modes if text columns
have gaps. The fences hold for the filled data, but need no pass of their own: a filled
column is the original one plus copies of the fill value, so its quantiles are original
values at known ranks. ``FittedCleaning.transform`` is a single projection of built-in
expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanweave.functions import expressions as X
from loanweave.functions.roles import matching, numeric_columns, text_columns
from loanweave.operators.modes import modes
from loanweave.operators.profile import SENTINEL, per_column
from loanweave.operators.quantiles import Extent, kll_sketch, order_statistics, rank_of, read_sketches
from loanweave.sources.staging import staged

Names = tuple[str, ...]


@dataclass(frozen=True)
class CleaningSpec:
    """What to do with a table. Column lists take exact names or patterns (``DAYS_*``).

    Order of effect: row filter and repairs, dropping of sparse columns, fills, fences,
    resets, range refills. Listed columns that the table lacks are skipped.
    """

    sentinel_columns: Names = ()
    sentinel: int = SENTINEL
    negative_to_null: Names = ()
    flip_positive: Names = ()
    require_negative: str | None = None  # rows where this is not < 0 are removed

    sparse_share: float | None = None
    sparse_inclusive: bool = False  # also drop a column exactly at the share
    sparse_before_repair: bool = False  # judge the share on the raw values

    numeric_family: str = "plain"
    numeric_fill: Names = ("*",)  # filled with the median
    text_fill: str | None = "mode"  # "mode", "constant" or None
    text_constant: str = "Unknown"
    text_fill_columns: Names = ("*",)

    fences: Names = ()
    fence_factor: float = 3.0
    reset_to_zero: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    refill: Mapping[str, tuple[float, float]] = field(default_factory=dict)

    rel_error: float = 0.001
    mode_candidates: bool = False  # for text of very many values, see ``frequent_mode_table``
    sketch: bool = False  # medians and quartiles from sketches made in the counting scan, see ``order_statistics``

    def repaired(self, columns: list[str]) -> dict[str, str]:
        """SQL text of every column after the repairs."""
        out = {c: X.quoted(c) for c in columns}
        for c in matching(columns, self.sentinel_columns):
            out[c] = X.nullify(out[c], self.sentinel)
        for c in matching(columns, self.negative_to_null):
            out[c] = X.null_negative(out[c])
        for c in matching(columns, self.flip_positive):
            out[c] = X.flip_positive(out[c])
        return out

    def kept_rows(self, columns: list[str]) -> str:
        if self.require_negative in columns:
            return f"coalesce({X.quoted(self.require_negative)} < 0, false)"
        return "true"

    def fit(self, df: DataFrame) -> "FittedCleaning":
        keep, profile, found = self._surviving(df)
        df = df.selectExpr(*map(X.quoted, keep))
        repaired = self.repaired(keep)
        kept = df.where(self.kept_rows(keep)) if self.require_negative else df
        types = {f.name: f.dataType for f in df.schema}

        numbers = {c: _Numbers(self, c, profile[c]) for c in keep if c in profile and profile[c]["n"]}
        ranks = {c: v.ranks() for c, v in numbers.items() if v.ranks()}
        extents = {c: v.extent for c, v in numbers.items()}
        if not self.sketch:
            found = order_statistics(kept, repaired, ranks, extents, self.rel_error)
        fills: dict[str, object] = {}
        fences, refills = {}, {}
        for c, values in numbers.items():
            at = partial(_value_at, found, c)
            if values.copies:
                fills[c] = values.median(at)
            if values.fenced:
                q1, q3 = values.filled_quantile(0.25, at), values.filled_quantile(0.75, at)
                reach = self.fence_factor * (q3 - q1)
                fences[c] = (q1 - reach, q3 + reach)
            if values.refill:
                refills[c] = values.refill_median(at)

        texts = [c for c in text_columns(df.schema) if c in profile and profile[c]["nulls"]]
        texts = matching(texts, self.text_fill_columns)
        if self.text_fill == "constant":
            fills |= {c: self.text_constant for c in texts}
        elif self.text_fill == "mode":
            fills |= modes(kept, texts, self.mode_candidates)
        return FittedCleaning(self, tuple(keep), types, fills, fences, refills)

    def _surviving(self, df: DataFrame) -> tuple[list[str], dict[str, dict], dict[tuple[str, int], float]]:
        """Columns to keep, the profile of every column that matters, and with ``sketch`` the order
        statistics that follow from it; all from one scan."""
        columns = df.columns
        repaired, rows = self.repaired(columns), self.kept_rows(columns)
        numeric = numeric_columns(df.schema, self.numeric_family)
        numeric = matching(numeric, (*self.numeric_fill, *self.fences, *self.refill))
        texts = matching(text_columns(df.schema), self.text_fill_columns if self.text_fill else ())
        profiled = columns if self.sparse_share is not None else [*numeric, *texts]

        def stats(name: str) -> dict[str, str]:
            value = f"CASE WHEN {rows} THEN {repaired[name]} END" if self.require_negative else repaired[name]
            judged = X.quoted(name) if self.sparse_before_repair else repaired[name]
            missing = f"{repaired[name]} IS NULL"
            missing = f"{rows} AND {missing}" if self.require_negative else missing
            lower, upper = self.refill.get(name, ("NULL", "NULL"))
            extent = Extent.measures(value if name in numeric else "NULL")
            return {
                "judged_nulls": f"count_if({judged} IS NULL)",
                "nulls": f"count_if({missing})",
                "below": f"count_if({value} < {lower})" if name in self.refill else "count_if(false)",
                "within": f"count_if({value} BETWEEN {lower} AND {upper})" if name in self.refill else "count_if(false)",
                **extent,
                **({"sketch": kll_sketch(value if name in numeric else "NULL", self.rel_error)} if self.sketch else {}),
            }

        counted, found = per_column(df, profiled, stats), {}
        if self.sketch:
            with staged(counted, "sketches") as counted:
                profile = {r["column"]: r.asDict() for r in counted.drop("sketch").collect()}
                numbers = {c: _Numbers(self, c, p) for c, p in profile.items() if p["n"]}
                found = read_sketches(counted, {c: v.ranks() for c, v in numbers.items()}, {c: v.extent for c, v in numbers.items()})
        else:
            profile = {r["column"]: r.asDict() for r in counted.collect()}
        keep = [c for c in columns if c not in profile or not self._is_sparse(profile[c])]
        if self.require_negative in columns and self.require_negative not in keep:
            # The filter column itself is gone, so no row is removed after all.
            again = replace(self, require_negative=None, sparse_share=None)
            return again._surviving(df.selectExpr(*map(X.quoted, keep)))
        return keep, profile, found

    def _is_sparse(self, stats: dict) -> bool:
        if self.sparse_share is None or not stats["rows"]:
            return False
        share = stats["judged_nulls"] / stats["rows"]
        return share >= self.sparse_share if self.sparse_inclusive else share > self.sparse_share


def _value_at(found: Mapping[tuple[str, int], float], column: str, rank: int) -> float:
    return found[column, rank]


class _Numbers:
    """The repaired values of a column and the copies of the median that fill its gaps.

    Everything asked for is an order statistic of the values, at a rank that follows
    from the counts of the profile.
    """

    def __init__(self, spec: CleaningSpec, name: str, stats: Mapping) -> None:
        self.extent = Extent.of(stats)
        filled = matching([name], spec.numeric_fill)
        self.copies = stats["nulls"] if filled else 0
        self.fenced = bool(matching([name], spec.fences))
        self.refill = spec.refill.get(name)
        self.below, self.within = stats["below"], stats["within"]  # the refill range

    def ranks(self) -> list[int]:
        """Every rank that could be asked for."""
        n, wanted = self.extent.n, set()
        if self.copies:
            wanted.add(rank_of(0.5, n))
        spans = [(p, n, 0, self.copies) for p in (0.25, 0.75)] if self.fenced else []
        if self.refill:
            spans += [(0.5, self.within, self.below, copies) for copies in {0, self.copies}]
        for p, size, start, copies in spans:
            k = rank_of(p, size + copies)
            wanted |= {start + r for r in (k, k - copies) if 1 <= r <= size}
        return sorted(wanted)

    def median(self, at: Callable[[int], float]) -> float:
        return at(rank_of(0.5, self.extent.n))

    def filled_quantile(self, p: float, at: Callable[[int], float]) -> float:
        return self._merged(p, self.extent.n, 0, self.copies, at)

    def refill_median(self, at: Callable[[int], float]) -> float | None:
        """Median of what is in range once the gaps are filled; None if nothing is."""
        lower, upper = self.refill
        copies = self.copies if self.copies and lower <= self.median(at) <= upper else 0
        if not self.within + copies:
            return None
        return self._merged(0.5, self.within, self.below, copies, at)

    def _merged(self, p: float, n: int, start: int, copies: int, at: Callable[[int], float]) -> float:
        """Quantile of the ``n`` values after rank ``start`` together with the copies."""
        k = rank_of(p, n + copies)
        if not copies:
            return at(start + k)
        fill = self.median(at)
        if k <= n and (value := at(start + k)) < fill:
            return value
        if k > copies and (value := at(start + k - copies)) > fill:
            return value
        return fill


@dataclass(frozen=True)
class FittedCleaning:
    """Plain fitted values; can be applied to the fitted table or to another one."""

    spec: CleaningSpec
    columns: Names
    types: Mapping[str, T.DataType]
    fills: Mapping[str, object]  # typed as the column, so an int column stays int
    fence_bounds: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    refills: Mapping[str, float | None] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        spec, columns = self.spec, list(self.columns)
        sql = spec.repaired(columns)
        texts = {c: v for c, v in self.fills.items() if isinstance(v, str)}
        for c in columns:
            kind = self.types[c].simpleString()
            if c in self.fills and c not in texts:
                sql[c] = X.fill(sql[c], self.fills[c], kind)
            if c in self.fence_bounds:
                sql[c] = X.clip(sql[c], *self.fence_bounds[c])
            if c in spec.reset_to_zero:
                sql[c] = X.reset_outside(sql[c], *spec.reset_to_zero[c])
            if c in spec.refill:
                sql[c] = X.null_outside(sql[c], *spec.refill[c])
                if self.refills.get(c) is not None:
                    sql[c] = X.fill(sql[c], self.refills[c], kind)
        rows = df.where(spec.kept_rows(columns)) if spec.require_negative else df
        out = {c: F.expr(sql[c]) for c in columns}
        out |= {c: F.coalesce(out[c], F.lit(text)) for c, text in texts.items()}
        return rows.select(*[value.alias(c) for c, value in out.items()])


def clean(df: DataFrame, spec: CleaningSpec) -> DataFrame:
    """Fit on the table and apply to the same table."""
    return spec.fit(df).transform(df)


def drop_sparse(df: DataFrame, share: float = 0.5, inclusive: bool = True) -> DataFrame:
    """Without the columns whose NULL share is above (or at) ``share``. An empty table keeps all."""
    spec = CleaningSpec(
        numeric_fill=(), text_fill=None, sparse_share=share, sparse_inclusive=inclusive
    )
    return clean(df, spec)


def fill_median(df: DataFrame, columns: Names = ("*",), rel_error: float = 0.001, sketch: bool = False) -> DataFrame:
    return clean(df, CleaningSpec(numeric_fill=columns, text_fill=None, rel_error=rel_error, sketch=sketch))


def fill_mode(df: DataFrame, columns: Names = ("*",), by_candidates: bool = False) -> DataFrame:
    """A column whose most frequent value is NULL or empty stays as it is."""
    return clean(df, CleaningSpec(numeric_fill=(), text_fill_columns=columns, mode_candidates=by_candidates))


def fill_constant(df: DataFrame, value: str = "Unknown") -> DataFrame:
    texts = text_columns(df.schema)
    return df.withColumns({c: F.coalesce(F.col(X.quoted(c)), F.lit(value)) for c in texts})


def fence(
    df: DataFrame, columns: Names, factor: float = 3.0, rel_error: float = 0.001
) -> DataFrame:
    """Clip to ``[q1 - factor * iqr, q3 + factor * iqr]``."""
    spec = CleaningSpec(
        numeric_fill=(), text_fill=None, fences=columns, fence_factor=factor, rel_error=rel_error
    )
    return clean(df, spec)


def refill_outside(
    df: DataFrame, ranges: Mapping[str, tuple[float, float]], rel_error: float = 0.001
) -> DataFrame:
    """Values out of range become NULL; then all NULLs of the column become the median."""
    spec = CleaningSpec(numeric_fill=(), text_fill=None, refill=ranges, rel_error=rel_error)
    return clean(df, spec)
