"""Roll-ups of a side table to one row per key, declared as data."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweave.functions import measures as M
from loanweave.functions.expressions import quoted


@dataclass(frozen=True)
class Rollup:
    """``measures`` and ``derived`` map output names to SQL expressions.

    All measures combine on the map side, so each task sends one row per key and a key
    that holds a third of the table is no heavier after the shuffle than any other.
    """

    key: str
    measures: Mapping[str, str]
    derived: Mapping[str, str] = field(default_factory=dict)

    def __call__(self, df: DataFrame) -> DataFrame:
        if self.derived:
            df = df.withColumns({name: F.expr(sql) for name, sql in self.derived.items()})
        return df.groupBy(self.key).agg(*[F.expr(sql).alias(n) for n, sql in self.measures.items()])


def bureau_rollup(
    key: str = "SK_ID_CURR",
    loan: str = "SK_ID_BUREAU",
    credit: str = "AMT_CREDIT_SUM",
    debt: str = "AMT_CREDIT_SUM_DEBT",
    days: str = "DAYS_CREDIT",
    status: str = "CREDIT_ACTIVE",
    scale: M.Scale = M.ANY,
) -> Rollup:
    return Rollup(
        key,
        {
            "bureau_loan_count": M.count(loan),
            "bureau_total_credit": M.total(credit, scale),
            "bureau_total_debt": M.total(debt, scale),
            "bureau_avg_days_credit": M.mean(days),
            "bureau_active_loans": M.count_equal(status, "Active"),
        },
    )


def balance_rollup(
    key: str = "SK_ID_BUREAU", month: str = "MONTHS_BALANCE", status: str = "STATUS"
) -> Rollup:
    return Rollup(key, {"bb_months_count": M.count(month), "bb_avg_status": M.text_mean(status)})


def balance_parts_rollup(
    key: str = "SK_ID_BUREAU", month: str = "MONTHS_BALANCE", status: str = "STATUS"
) -> Rollup:
    """As ``balance_rollup`` with sum and count apart, so a second level can merge them."""
    return Rollup(
        key,
        {
            "bb_months_count": M.count(month),
            "bb_status_sum": M.text_sum(status),
            "bb_status_count": M.text_count(status),
        },
    )


def balance_second_level(key: str = "SK_ID_CURR", loan: str = "SK_ID_BUREAU") -> Rollup:
    """Loans enriched with ``balance_parts_rollup`` to one row per applicant."""
    return Rollup(
        key,
        {
            "bb_loans": M.count(loan),
            "bb_loans_with_history": M.count("bb_months_count"),
            "bb_months_total": M.total("bb_months_count"),
            "bb_avg_status": "try_divide(sum(bb_status_sum), sum(bb_status_count))",
        },
    )


def previous_rollup(
    key: str = "SK_ID_CURR",
    loan: str = "SK_ID_PREV",
    application: str = "AMT_APPLICATION",
    credit: str = "AMT_CREDIT",
    status: str = "NAME_CONTRACT_STATUS",
    scale: M.Scale = M.ANY,
) -> Rollup:
    return Rollup(
        key,
        {
            "prev_app_count": M.count(loan),
            "prev_avg_application": M.mean(application, scale),
            "prev_avg_credit": M.mean(credit, scale),
            "prev_approved_count": M.count_equal(status, "Approved"),
            "prev_refused_count": M.count_equal(status, "Refused"),
        },
    )


def installments_rollup(
    key: str = "SK_ID_CURR",
    loan: str = "SK_ID_PREV",
    due: str = "AMT_INSTALMENT",
    paid: str = "AMT_PAYMENT",
    due_day: str = "DAYS_INSTALMENT",
    paid_day: str = "DAYS_ENTRY_PAYMENT",
    scale: M.Scale = M.ANY,
) -> Rollup:
    return Rollup(
        key,
        {
            "inst_count": M.count(loan),
            "inst_avg_payment_diff": M.mean("payment_diff", scale),
            "inst_avg_days_late": M.mean("days_late"),
            "inst_late_count": M.count_positive("days_late"),
        },
        derived={
            "payment_diff": f"{quoted(due)} - {quoted(paid)}",
            "days_late": f"{quoted(paid_day)} - {quoted(due_day)}",
        },
    )


def card_rollup(
    key: str = "SK_ID_CURR",
    balance: str = "AMT_BALANCE",
    limit: str = "AMT_CREDIT_LIMIT_ACTUAL",
    drawings: str = "CNT_DRAWINGS_TOTAL",
    scale: M.Scale = M.ANY,
) -> Rollup:
    return Rollup(
        key,
        {
            "cc_avg_balance": M.mean(balance, scale),
            "cc_avg_credit_limit": M.mean(limit),
            "cc_avg_drawings": M.mean(drawings),
        },
    )


def pos_rollup(
    key: str = "SK_ID_CURR",
    loan: str = "SK_ID_PREV",
    instalments: str = "CNT_INSTALMENT",
    status: str = "NAME_CONTRACT_STATUS",
) -> Rollup:
    return Rollup(
        key,
        {
            "pos_count": M.count(loan),
            "pos_avg_instalment": M.mean(instalments),
            "pos_active_count": M.count_equal(status, "Active"),
        },
    )
