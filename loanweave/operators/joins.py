"""Left joins of per-key roll-ups onto a base table.

Strategies:

``auto``       no hint; Catalyst and adaptive execution choose from sizes they know.
``shuffle``    sort-merge joins. The base is shuffled once for the whole chain, and a
               roll-up is already partitioned on the key by its own grouping.
``broadcast``  each side is staged and measured; it is broadcast only if it is within
               the limit, and merged by shuffle otherwise.

A base key (or NULL) that holds a large share of the rows would send them all to one
task of a shuffled join. With ``hot_share``, such keys are found by a bounded sketch and
their rows are joined apart from the rest. The side's rows of the hot keys are broadcast if
they are measured to be within the limit. A side that repeats a hot key more often than that
is salted: base rows are dealt to ``SALTS`` parts of their key in turn, and the side's rows
are copied to every part. Leave ``hot_share`` out for a base that is unique on the key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanweave.functions.expressions import quoted
from loanweave.sources.staging import measured_bytes, stage_all, stage_measured

BROADCAST_LIMIT = 50 * 1024 * 1024
# These two only route rows: a hot key beyond them is joined like any other.
MAX_HOT = 1000
_TRACKED = 4096  # sketch entries; finds any key above 1/3000 of the rows
SALTS = 32


def left_join(
    base: DataFrame,
    other: DataFrame,
    on: str,
    strategy: str = "auto",
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Left outer equi-join on one column; unmatched rows get NULLs."""
    if strategy == "broadcast":
        other = stage_measured(other, "side")
        strategy = "broadcast_checked" if measured_bytes(other) <= limit else "shuffle"
    return _join(base, other, on, strategy)


def _join(base: DataFrame, other: DataFrame, on: str, strategy: str) -> DataFrame:
    if strategy == "broadcast_checked":
        other = F.broadcast(other)
    elif strategy == "shuffle":
        other = other.hint("merge")
    elif strategy != "auto":
        raise ValueError(f"unknown join strategy {strategy!r}")
    return base.join(other, on, "left")


def hot_keys(df: DataFrame, key: str, share: float) -> list:
    """Keys (None for NULL) with more than ``share`` of the rows, so at most 1/share of them.

    One scan of the key column. Sketches are merged in two levels, so no single task
    receives one per scan task. The estimate only decides how rows are routed.
    """
    if df.isEmpty():  # a sketch of nothing cannot be read
        return []
    groups = F.pmod(F.spark_partition_id(), F.lit(64))
    sketch = f"approx_top_k_accumulate({quoted(key)}, {_TRACKED})"
    row = (
        df.groupBy(groups.alias("part"))
        .agg(F.expr(sketch).alias("s"), F.count(F.lit(1)).alias("n"))
        .agg(F.expr(f"approx_top_k_combine(s, {_TRACKED})").alias("s"), F.sum("n").alias("n"))
        .select(F.expr(f"approx_top_k_estimate(s, {MAX_HOT})").alias("top"), "n")
        .first()
    )
    return [item["item"] for item in row["top"] if item["count"] > share * row["n"]]


def _is_hot(key: str, keys: Sequence) -> Column:
    named = [k for k in keys if k is not None]
    return F.col(quoted(key)).isNull() | F.col(quoted(key)).isin(named)


def salted_join(base: DataFrame, other: DataFrame, on: str, salts: int = SALTS) -> DataFrame:
    """Left equi-join in which the rows of each base key are spread over ``salts`` tasks.

    ``other`` may repeat keys; its rows are copied ``salts`` times. Meant for hot keys only.
    """
    salt = "salt"
    while salt in {c.lower() for c in (*base.columns, *other.columns)}:
        salt = f"_{salt}"
    dealt = base.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    copied = other.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copied.hint("merge"), [on, salt], "left").drop(salt)


def _join_hot(base: DataFrame, side: DataFrame, on: str, keys: Sequence, limit: int) -> DataFrame:
    """Base rows of the hot keys with the side's rows of these keys, of which there may be several."""
    found = side.where(F.col(quoted(on)).isin([k for k in keys if k is not None]))
    if measured_bytes(found) <= limit:
        return _join(base, found, on, "broadcast_checked")
    return salted_join(base, found, on)


def attach(
    base: DataFrame,
    sides: Sequence[DataFrame],
    on: str,
    strategy: str = "auto",
    limit: int = BROADCAST_LIMIT,
    hot_share: float | None = None,
) -> DataFrame:
    """Left-join every side onto ``base``, in the given order. A side usually has one row per key;
    one that repeats a key repeats the base rows.

    With ``hot_share``, base keys above that share of the rows are joined apart. The sides
    are then staged, so each is computed once for both parts.
    """
    chosen = [strategy] * len(sides)
    if strategy == "broadcast":
        sides = stage_all(sides, "side")
        chosen = ["broadcast_checked" if measured_bytes(s) <= limit else "shuffle" for s in sides]
    cold, hot = base, None
    if hot_share is not None and any(c != "broadcast_checked" for c in chosen):
        keys = hot_keys(base, on, hot_share)
        if keys:
            sides, split = stage_all(sides, "side"), _is_hot(on, keys)
            cold, hot = base.where(~split), base.where(split)
    out = _chain(cold, sides, on, chosen)
    if hot is not None:
        out = out.unionByName(reduce(lambda left, side: _join_hot(left, side, on, keys, limit), sides, hot))
    return out


def _chain(base: DataFrame, sides: Sequence[DataFrame], on: str, chosen: Sequence[str]) -> DataFrame:
    return reduce(lambda left, pair: _join(left, pair[0], on, pair[1]), zip(sides, chosen), base)
