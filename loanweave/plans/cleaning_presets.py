"""Cleaning specs for the loan tables, under two contracts.

``basic`` covers the application table only: drop columns that are at least half
empty, remove rows without a negative birth offset, repair the employment marker, fill
text with a constant and numbers with the median.

``thorough`` covers all eight tables: repair first, drop columns that are more than
60 % empty, fill with median and mode, then fence outliers in the application table.
"""

from __future__ import annotations

from loanweave.operators.cleaning import CleaningSpec

DAYS = ("DAYS_*",)


def basic_application(
    birth: str = "DAYS_BIRTH", employed: str = "DAYS_EMPLOYED", rel_error: float = 0.01
) -> CleaningSpec:
    return CleaningSpec(
        sparse_share=0.5,
        sparse_inclusive=True,
        sparse_before_repair=True,
        require_negative=birth,
        sentinel_columns=(employed,),
        numeric_family="any",
        text_fill="constant",
        rel_error=rel_error,
    )


def application(
    days: tuple[str, ...] = DAYS,
    employed: str = "DAYS_EMPLOYED",
    amounts: tuple[str, ...] = ("AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE"),
    children: str = "CNT_CHILDREN",
    car_age: str = "OWN_CAR_AGE",
    rel_error: float = 0.001,
) -> CleaningSpec:
    return CleaningSpec(
        sentinel_columns=(employed,),
        flip_positive=days,
        sparse_share=0.6,
        fences=amounts,
        reset_to_zero={children: (0, 10)},
        refill={car_age: (0, 100)},
        rel_error=rel_error,
    )


def bureau(days: tuple[str, ...] = DAYS, rel_error: float = 0.001) -> CleaningSpec:
    return CleaningSpec(flip_positive=days, sparse_share=0.6, rel_error=rel_error)


def bureau_balance(status: str = "STATUS", rel_error: float = 0.001) -> CleaningSpec:
    return CleaningSpec(text_fill_columns=(status,), rel_error=rel_error)


def previous_application(days: tuple[str, ...] = DAYS, rel_error: float = 0.001) -> CleaningSpec:
    return CleaningSpec(
        sentinel_columns=days, flip_positive=days, sparse_share=0.6, rel_error=rel_error
    )


def pos_cash(rel_error: float = 0.001) -> CleaningSpec:
    return CleaningSpec(rel_error=rel_error)


def credit_card(rel_error: float = 0.001) -> CleaningSpec:
    return CleaningSpec(rel_error=rel_error)


def installments(
    amounts: tuple[str, ...] = ("AMT_PAYMENT", "AMT_INSTALMENT"),
    days: tuple[str, ...] = DAYS,
    rel_error: float = 0.001,
) -> CleaningSpec:
    return CleaningSpec(
        negative_to_null=amounts, flip_positive=days, text_fill=None, rel_error=rel_error
    )


def thorough() -> dict[str, CleaningSpec]:
    """Spec per table name. Train and test tables are each fitted on their own data."""
    return {
        "app_train": application(),
        "app_test": application(),
        "bureau": bureau(),
        "bureau_bal": bureau_balance(),
        "prev_app": previous_application(),
        "pos_cash": pos_cash(),
        "credit_card": credit_card(),
        "installments": installments(),
    }
