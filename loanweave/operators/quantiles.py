"""Order statistics of many columns at once, by counting values in narrowing brackets.

One round puts every value of the wanted columns into one of many parts of a bracket and
counts. The counts combine on the map side, so a round shuffles at most about
``ROWS_PER_TASK`` small rows per task, however large or skewed the data is, and all
reducers share them. The part that holds the wanted rank becomes the next bracket, and
only rows inside it are looked at again. The first round divides on a logarithmic scale,
so that far outliers do not push all other values into one part. With a tolerated rank
error most searches end after one or two rounds.

Compared with merging one quantile sketch per task and column in a single reducer, the
result does not depend on partitioning or merge order (a retried task cannot change a
fill value), it can be exact, and no step holds more than a bounded state.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweave.functions.expressions import comparable, double, quoted, text
from loanweave.operators.profile import by_group

ROWS_PER_TASK = 65_536
MOST_PARTS, FEWEST_PARTS = 16_384, 1_024
COLUMNS_AT_ONCE = 64


def rank_of(p: float, n: int) -> int:
    """1-based rank of quantile ``p`` among ``n`` values."""
    return max(1, math.ceil(p * n))


@dataclass(frozen=True)
class Extent:
    """Count and bounds of a column's values (NULL and NaN apart)."""

    n: int
    lower: float
    upper: float

    @staticmethod
    def measures(value: str) -> dict[str, str]:
        """Aggregates, as SQL, that ``of`` reads."""
        v = comparable(value)
        return {"n": f"count({v})", "lower": f"min({v})", "upper": f"max({v})"}

    @classmethod
    def of(cls, row: Mapping) -> "Extent":
        return cls(row["n"], row["lower"], row["upper"])


@dataclass(frozen=True)
class _Search:
    column: str
    asked: int  # rank among all values
    rank: int  # rank among the values counted in this round
    lower: float
    upper: float
    narrowed: bool = False

    @property
    def bracket(self) -> tuple[str, float, float]:
        return self.column, self.lower, self.upper


def _scaled(x: float) -> float:
    return math.copysign(math.log1p(abs(x)), x)


def _division(search: _Search) -> tuple[int, float, float]:
    """How a bracket is divided: (kind, start, width). Logarithmic 0, even 1, in three 2."""
    lower, upper = search.lower, search.upper
    log_width = _scaled(upper) - _scaled(lower)
    half = upper / 2 - lower / 2  # halves keep the width finite for any two doubles
    if not search.narrowed and 0 < log_width < math.inf:
        return 0, _scaled(lower), log_width
    if 0 < half < math.inf:
        return 1, lower / 2, half
    return 2, 0.0, 1.0  # an infinite bound, or a width too small to divide by


# The index of the part that ``value`` is in; -1 below the bracket, {parts} above. It never
# falls as the value rises, which is all that the counting relies on.
_PART = """
CASE WHEN value < lower THEN -1 WHEN value > upper THEN {parts} ELSE
  greatest(0, least({parts} - 1, CAST(floor({parts} *
    CASE kind WHEN 0 THEN (signum(value) * log1p(abs(value)) - start) / width
              WHEN 1 THEN (value / 2 - start) / width
              ELSE CASE WHEN value = lower THEN 0D WHEN value = upper THEN 1D ELSE 0.5D END END
  ) AS INT))) END AS part"""


def _round(df: DataFrame, searches: Sequence[_Search], values: Mapping[str, str]) -> list:
    """The part that holds each search's rank: one row per search."""
    by_bracket: dict[tuple, list[int]] = {}
    for i, s in enumerate(searches):
        by_bracket.setdefault(s.bracket, []).append(i)
    cells = [searches[own[0]] for own in by_bracket.values()]
    parts = max(FEWEST_PARTS, min(MOST_PARTS, ROWS_PER_TASK // len(cells)))

    def within(s: _Search, v: str) -> str:
        return f"{v} BETWEEN {double(s.lower)} AND {double(s.upper)}"

    if all(s.narrowed for s in cells):
        df = df.where(" OR ".join(within(s, values[s.column]) for s in cells))
    inputs = []
    for s in cells:
        v = comparable(values[s.column])
        inputs.append(f"CASE WHEN {within(s, v)} THEN {v} END" if s.narrowed else v)
    # One array per setting, looked up by cell: the code that runs per value stays small,
    # however many columns there are.
    divisions = [_division(s) for s in cells]
    settings = {
        "lower": [double(s.lower) for s in cells],
        "upper": [double(s.upper) for s in cells],
        "kind": [str(kind) for kind, _, _ in divisions],
        "start": [double(start) for _, start, _ in divisions],
        "width": [double(width) for _, _, width in divisions],
    }
    ranks = [
        "array(" + ", ".join(f"named_struct('search', {i}, 'rank', {searches[i].rank}L)" for i in own) + ")"
        for own in by_bracket.values()
    ]
    return (
        df.selectExpr(f"posexplode(array({', '.join(inputs)})) AS (cell, value)")
        .where("value IS NOT NULL")
        .selectExpr("cell", "value", *[f"array({', '.join(v)})[cell] AS {k}" for k, v in settings.items()])
        .selectExpr("cell", "value", _PART.format(parts=parts))
        .groupBy("cell", "part")
        .agg(F.count("value").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        .selectExpr("*", "sum(n) OVER (PARTITION BY cell ORDER BY part) - n AS before")
        .selectExpr("n", "lo", "hi", "before", f"inline(array({', '.join(ranks)})[cell])")
        .where("before < rank AND rank <= before + n")
        .selectExpr("search", "n", "lo", "hi", "rank - before AS rank")
        .collect()
    )


def kll_size(rel_error: float) -> int:
    """Size of a KLL sketch whose rank error is below ``rel_error`` five standard errors out of six.

    The published error at 99 % is 2.296 / k^0.9723; half of ``rel_error`` is put there, so a
    wrong rank has a chance below one in a million.
    """
    if not 0 < rel_error < 1:
        raise ValueError("sketches need a rank error between 0 and 1")
    return max(8, min(65_535, math.ceil((2 * 2.296 / rel_error) ** (1 / 0.9723))))


def kll_sketch(value: str, rel_error: float) -> str:
    """Aggregate, as SQL, that sketches a column's values; see ``read_sketches``."""
    return f"kll_sketch_agg_double({comparable(value)}, {kll_size(rel_error)})"


def read_sketches(
    sketches: DataFrame, wanted: Mapping[str, Sequence[int]], extents: Mapping[str, Extent]
) -> dict[tuple[str, int], float]:
    """Values at the wanted ranks from rows ``(column, sketch)``, of which there is one per column.
    The first and last rank are the bounds themselves."""
    asked = {c: sorted(set(ranks)) for c, ranks in wanted.items() if ranks}
    shares = sorted({r / extents[c].n for c, ranks in asked.items() for r in ranks})  # must be literals
    if not shares:
        return {}
    place = {share: i for i, share in enumerate(shares)}
    read = F.expr(f"kll_sketch_get_quantile_double(sketch, array({', '.join(map(double, shares))}))")
    rows = sketches.where(F.col("column").isin(*asked)).select("column", read.alias("values")).collect()
    out = {(r["column"], k): r["values"][place[k / extents[r["column"]].n]] for r in rows for k in asked[r["column"]]}
    ends = {(c, k): extents[c].lower if k == 1 else extents[c].upper for c, ranks in asked.items() for k in ranks if k in (1, extents[c].n)}
    return out | ends


def _from_sketches(
    df: DataFrame, values: Mapping[str, str], wanted: Mapping[str, Sequence[int]], extents: Mapping[str, Extent], rel_error: float
) -> dict[tuple[str, int], float]:
    found, names = {}, list(wanted)
    for first in range(0, len(names), COLUMNS_AT_ONCE):
        batch = names[first : first + COLUMNS_AT_ONCE]
        cells = ", ".join(f"named_struct('column', {text(c)}, 'sketch', {kll_sketch(values[c], rel_error)})" for c in batch)
        groups = by_group(df, F.expr(f"array({cells})").alias("cells")).select(F.inline("cells"))
        merged = groups.groupBy("column").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
        found |= read_sketches(merged, {c: wanted[c] for c in batch}, extents)
    return found


def order_statistics(
    df: DataFrame,
    values: Mapping[str, str],
    wanted: Mapping[str, Sequence[int]],
    extents: Mapping[str, Extent],
    rel_error: float = 0.0,
    sketch: bool = False,
) -> dict[tuple[str, int], float]:
    """Value at each ``(column, rank)`` of ``wanted``; ranks count from 1, NULL and NaN apart.

    ``values`` are SQL expressions. With ``rel_error``, a value whose rank differs by at
    most that share of the column's values may be returned; zero means exact.

    ``sketch`` reads the values off one KLL sketch per column instead of counting in rounds:
    one pass, which suits wide tables. Every task sends a sketch of about 15 / ``rel_error``
    values per column at most; sketches are merged in groups first. They draw at random, so
    another run can return another value within the error. It needs ``rel_error``.
    """
    found: dict[tuple[str, int], float] = {}
    names = [c for c, ranks in wanted.items() if ranks]
    if sketch:
        return _from_sketches(df, values, {c: sorted(set(wanted[c])) for c in names}, extents, rel_error)
    # A batch of columns keeps within the limits of code generation. Batches share no
    # column, so a columnar source is not read twice.
    for first in range(0, len(names), COLUMNS_AT_ONCE):
        searches = [
            _Search(c, r, r, extents[c].lower, extents[c].upper)
            for c in names[first : first + COLUMNS_AT_ONCE]
            for r in sorted(set(wanted[c]))
        ]
        while searches:
            following = []
            for row in _round(df, searches, values):
                s = searches[row["search"]]
                if row["rank"] == 1 or row["lo"] == row["hi"]:
                    found[s.column, s.asked] = row["lo"]
                elif row["rank"] == row["n"] or row["n"] <= rel_error * extents[s.column].n:
                    found[s.column, s.asked] = row["hi"]
                else:
                    following.append(_Search(s.column, s.asked, row["rank"], row["lo"], row["hi"], True))
            # Searches of one column that land in the same part share the next bracket.
            searches = following
    return found


def quantiles(
    df: DataFrame,
    probabilities: Mapping[str, Sequence[float]],
    rel_error: float = 0.0,
    values: Mapping[str, str] | None = None,
) -> dict[str, list[float | None]]:
    """For each name in ``probabilities``, the values at those quantiles.

    The quantile ``p`` of ``n`` values is the one at rank ``max(1, ceil(p * n))``, so it
    is always an element of the data. A column without values gives ``None``. ``values``
    gives the SQL expression of a name that is not simply a column.
    """
    names = [c for c, ps in probabilities.items() if ps]
    if not names:
        return {c: [] for c in probabilities}
    sql = {c: (values or {}).get(c, quoted(c)) for c in names}
    row = df.selectExpr(
        *[f"{m} AS {k}{i}" for i, c in enumerate(names) for k, m in Extent.measures(sql[c]).items()]
    ).first()
    extents = {c: Extent.of({k: row[f"{k}{i}"] for k in ("n", "lower", "upper")}) for i, c in enumerate(names)}
    ranks = {c: [rank_of(p, extents[c].n) for p in probabilities[c]] for c in names if extents[c].n}
    found = order_statistics(df, sql, ranks, extents, rel_error)
    return {
        c: [found[c, r] for r in ranks[c]] if c in ranks else [None] * len(ps)
        for c, ps in probabilities.items()
    }
