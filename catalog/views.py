"""The test tables in the roles of the loan tables.

Each view is one list of select expressions that reads the same in Spark SQL and in
ANSI SQL, but for the number of days between two dates.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanweave.sources.staging import stage

Columns = tuple[str, ...]
ORIGIN = "DATE '2002-01-01'"
LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"


def _views(days: Callable[[str], str]) -> dict[str, tuple[str, Columns]]:
    """Name -> (source tables, select expressions)."""
    return {
        "v_app": (
            "customer",
            (
                "c_custkey AS app_id",
                "CASE WHEN c_custkey % 12 = 0 THEN 1 ELSE 0 END AS target",
                "CAST(CASE WHEN c_custkey % 211 = 0 THEN 1 ELSE -7000 - c_custkey % 18000 END AS INT) AS days_birth",
                "CAST(CASE WHEN c_custkey % 5 = 0 THEN 365243 ELSE -1 - c_custkey % 9000 END AS INT) AS days_employed",
                "CAST(CASE WHEN c_custkey % 17 = 0 THEN 1 + c_custkey % 100 ELSE -1 - c_custkey % 4000 END AS INT) AS days_registration",
                "CAST(CASE WHEN c_custkey % 97 = 0 THEN 0 WHEN c_custkey % 13 = 0 THEN NULL"
                " WHEN c_custkey % 101 = 0 THEN 1000000 ELSE c_acctbal + 1000 END AS DOUBLE) AS amt_income",
                "CAST(c_acctbal * 3 + 5000 AS DOUBLE) AS amt_credit",
                "CAST(CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE (c_acctbal + 2000) / 10 END AS DOUBLE) AS amt_annuity",
                "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS segment",
                "CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_mktsegment END AS occupation",
                "CAST(CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 130 END AS INT) AS car_age",
                "CAST(CASE WHEN c_custkey % 20 < 11 THEN NULL ELSE c_custkey % 90 END AS INT) AS house_age",
                "CAST(c_custkey % 130 AS INT) AS vehicle_age",
                "CAST(c_custkey % 13 - 1 AS INT) AS cnt_children",
            ),
        ),
        "v_bureau": (
            "orders",
            (
                "o_orderkey AS bureau_id",
                "o_custkey AS app_id",
                "CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed' ELSE 'Sold' END AS credit_active",
                f"CAST(CASE WHEN o_orderkey % 19 = 0 THEN 30 ELSE {days('o_orderdate')} END AS INT) AS days_credit",
                "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END AS amt_credit_sum",
                "CASE WHEN o_orderkey % 23 = 0 THEN -o_totalprice WHEN o_orderkey % 4 = 0 THEN NULL"
                " ELSE o_totalprice - 100 END AS amt_credit_sum_debt",
                "CASE WHEN o_orderkey % 10 < 7 THEN NULL ELSE o_totalprice END AS amt_overdue",
            ),
        ),
        "v_balance": (
            "lineitem",
            (
                "l_orderkey AS bureau_id",
                "CAST(-l_linenumber AS INT) AS months_balance",
                "CASE WHEN (l_orderkey + l_linenumber) % 31 = 0 THEN NULL"
                " WHEN l_returnflag = 'A' THEN 'C' WHEN l_returnflag = 'R' THEN '1' ELSE '0' END AS status",
            ),
        ),
        "v_prev": (
            "orders",
            (
                "o_orderkey AS prev_id",
                "o_custkey AS app_id",
                "CASE o_orderstatus WHEN 'O' THEN 'Approved' WHEN 'F' THEN 'Refused' ELSE 'Canceled' END AS contract_status",
                "o_totalprice AS amt_application",
                "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice * 2 END AS amt_credit",
                "CAST(CASE WHEN o_orderkey % 3 = 0 THEN 365243 WHEN o_orderkey % 16 = 0 THEN 15"
                f" ELSE {days('o_orderdate')} END AS INT) AS days_first_due",
                "CAST(CASE WHEN o_orderkey % 10 < 7 THEN 365243 ELSE -5 END AS INT) AS days_first_drawing",
                "CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderpriority END AS suite_type",
            ),
        ),
        "v_inst": (
            LINES,
            (
                "l_orderkey AS prev_id",
                "o_custkey AS app_id",
                "l_extendedprice AS amt_instalment",
                "CASE WHEN l_orderkey % 37 = 0 THEN -l_extendedprice WHEN l_orderkey % 41 = 0 THEN NULL"
                " ELSE l_extendedprice * (1 - l_discount) END AS amt_payment",
                f"CAST(CASE WHEN l_orderkey % 53 = 0 THEN 12 ELSE {days('o_orderdate')} END AS INT) AS days_instalment",
                f"CAST(CASE WHEN l_orderkey % 43 = 0 THEN NULL ELSE {days('l_shipdate')} END AS INT) AS days_entry_payment",
            ),
        ),
        "v_card": (
            "events",
            (
                "user_id AS app_id",
                "event_type AS card_status",
                "CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS amt_balance",
                "CAST(100 * (1 + user_id % 9) AS INT) AS amt_credit_limit",
                "CAST(CASE WHEN event_id % 15 = 0 THEN NULL ELSE event_id % 6 END AS INT) AS cnt_drawings",
            ),
        ),
        "v_pos": (
            LINES,
            (
                "l_orderkey AS prev_id",
                "o_custkey AS app_id",
                "CAST(CASE WHEN l_orderkey % 27 = 0 THEN NULL ELSE l_quantity END AS INT) AS cnt_instalment",
                "CASE WHEN l_orderkey % 33 = 0 THEN NULL WHEN l_linestatus = 'O' THEN 'Active'"
                " ELSE 'Completed' END AS contract_status",
            ),
        ),
    }


def _without_label(views: dict[str, tuple[str, Columns]]) -> dict[str, tuple[str, Columns]]:
    """Adds the test table, which is the application table without its label."""
    source, columns = views["v_app"]
    return {**views, "v_app_test": (source, tuple(c for c in columns if not c.endswith(" AS target")))}


_SPARK = _without_label(_views(lambda c: f"datediff({c}, {ORIGIN})"))
_ANSI = _without_label(_views(lambda c: f"date_diff('day', {ORIGIN}, CAST({c} AS DATE))"))


def _source(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    first, *rest = [spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in source.split(" ON ")[0].split(" JOIN ")]
    for other in rest:
        first = first.join(other, F.expr(source.split(" ON ")[1]))
    return first


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = _SPARK[name]
    return _source(spark, sf_dir, source).selectExpr(*columns)


def stored_views(spark: SparkSession, sf_dir: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """The views by name, for callers that scan them several times. Those over one join share it:
    the columns that they need of it are staged once."""
    out, joins = {}, {}
    for name in names:
        source, columns = _SPARK[name]
        if " JOIN " in source:
            joins.setdefault(source, []).append(name)
        out[name] = view(spark, sf_dir, name)
    for source, own in joins.items():
        joined = _source(spark, sf_dir, source)
        words = set(re.findall(r"\w+", " ".join(c for name in own for c in _SPARK[name][1])))
        rows = stage(joined.select([c for c in joined.columns if c in words]), "joined")
        out |= {name: rows.selectExpr(*_SPARK[name][1]) for name in own}
    return out


def ansi(name: str) -> str:
    source, columns = _ANSI[name]
    return f"SELECT {', '.join(columns)} FROM {source}"


def column_names(name: str) -> list[str]:
    return [c.rsplit(" AS ", 1)[1] for c in _SPARK[name][1]]
