"""The feature table: every side table rolled up and joined to the applications."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from contextlib import redirect_stdout
from io import StringIO

from pyspark.sql import DataFrame, SparkSession

from loanweave.operators import aggregates as A
from loanweave.operators.aggregates import Rollup
from loanweave.operators.joins import attach
from loanweave.sources.bucketed import store_bucketed
from loanweave.sources.tables import APPLICANT, read_cleaned
from loanweave.sources.writers import write_counted

SIDES = ("bureau", "prev_app", "installments", "credit_card", "pos_cash")


def default_rollups() -> dict[str, Rollup]:
    return {
        "bureau": A.bureau_rollup(),
        "prev_app": A.previous_rollup(),
        "installments": A.installments_rollup(),
        "credit_card": A.card_rollup(),
        "pos_cash": A.pos_rollup(),
    }


def loans_with_balance(
    bureau: DataFrame, balance: DataFrame, rollup: Rollup | None = None, strategy: str = "auto"
) -> DataFrame:
    """Bureau loans with their rolled-up monthly balance. Loans are unique on their key."""
    rollup = rollup or A.balance_rollup()
    return attach(bureau, [rollup(balance)], rollup.key, strategy)


def balance_features(
    bureau: DataFrame,
    balance: DataFrame,
    parts: Rollup | None = None,
    second: Rollup | None = None,
    strategy: str = "auto",
) -> DataFrame:
    """Monthly balances rolled up to loans and on to applicants."""
    second = second or A.balance_second_level()
    return second(loans_with_balance(bureau, balance, parts or A.balance_parts_rollup(), strategy))


def final_features(
    tables: Mapping[str, DataFrame],
    rollups: Mapping[str, Rollup] | None = None,
    base: str = "app_train",
    key: str = APPLICANT,
    strategy: str = "auto",
    with_balance: bool = False,
    hot_share: float | None = None,
    balance_rollups: tuple[Rollup, Rollup] | None = None,
    side_names: tuple[str, str] = ("bureau", "bureau_bal"),
) -> DataFrame:
    """Applications with all side roll-ups.

    ``with_balance`` adds the second-level balance features; they are off by default so
    that the columns are those of the five side tables. Applications are unique on their
    key; ``hot_share`` is for another base that is not.
    """
    rollups = rollups or default_rollups()
    sides = [rollup(tables[name]) for name, rollup in rollups.items()]
    if with_balance:
        bureau, balance = (tables[n] for n in side_names)
        sides.append(balance_features(bureau, balance, *(balance_rollups or (None, None)), strategy))
    return attach(tables[base], sides, key, strategy, hot_share=hot_share)


def bucketed_inputs(
    tables: Mapping[str, DataFrame],
    root: str,
    rollups: Mapping[str, Rollup] | None = None,
    base: str = "app_train",
    key: str = APPLICANT,
    buckets: int = 200,
) -> tuple[DataFrame, list[DataFrame]]:
    """The base and every rolled-up side, stored below ``root`` in buckets of the key. ``attach``
    by ``shuffle`` then merges them bucket by bucket, as often as wanted, without moving a row."""
    rollups = rollups or default_rollups()
    run = uuid.uuid4().hex
    frames = {base: tables[base]} | {f"side_{name}": rollup(tables[name]) for name, rollup in rollups.items()}
    stored = [store_bucketed(df, f"{name}_{run}", f"{root}/{name}", key, buckets) for name, df in frames.items()]
    return stored[0], stored[1:]


def build_final_features(
    spark: SparkSession,
    clean_root: str,
    target: str,
    pattern: str = "{stem}",
    strategy: str = "auto",
    with_balance: bool = False,
) -> int:
    """Read the cleaned tables, build the feature table and write it. Returns its rows."""
    names = ("app_train", *SIDES, *(("bureau_bal",) if with_balance else ()))
    tables = read_cleaned(spark, clean_root, names, pattern)
    return write_counted(final_features(tables, strategy=strategy, with_balance=with_balance), target)


def compare_strategies(
    base: DataFrame,
    sides: Sequence[DataFrame],
    key: str,
    strategies: Sequence[str] = ("shuffle", "broadcast"),
) -> DataFrame:
    """``(strategy, rows, plan_has_broadcast, seconds, speedup)``: the join chain timed per strategy.

    Every row is produced (``noop`` sink). A count would not do: the optimiser removes
    left joins whose columns nobody reads. ``plan_has_broadcast`` tells whether any join of the
    plan broadcasts a side. ``speedup`` is relative to the first strategy.
    """
    rows = []
    for strategy in strategies:
        start = time.perf_counter()
        joined = attach(base, sides, key, strategy)
        joined.write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - start
        rows.append((strategy, joined.count(), "BroadcastHashJoin" in plan_of(joined), seconds))
    first = rows[0][3]
    return base.sparkSession.createDataFrame(
        [(*r, first / r[3]) for r in rows],
        "strategy STRING, rows BIGINT, plan_has_broadcast BOOLEAN, seconds DOUBLE, speedup DOUBLE",
    )


def plan_of(df: DataFrame) -> str:
    """The physical plan as text."""
    with redirect_stdout(StringIO()) as out:
        df.explain()
    return out.getvalue()
