"""Registry of the eight loan tables: file names, keys and declared schemas."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from loanweave.sources.readers import read_csv

APPLICANT, BUREAU_LOAN, PREVIOUS_LOAN, LABEL = "SK_ID_CURR", "SK_ID_BUREAU", "SK_ID_PREV", "TARGET"


@dataclass(frozen=True)
class LoanTable:
    name: str
    stem: str  # file name without extension
    key: str
    schema: str | None = None  # DDL of the CSV, where all columns are known


# File stems and column layouts of the loan data set.
_TABLES = (
    LoanTable("app_train", "application_train", APPLICANT),
    LoanTable("app_test", "application_test", APPLICANT),
    LoanTable("bureau", "bureau", BUREAU_LOAN),
    LoanTable(
        "bureau_bal",
        "bureau_balance",
        BUREAU_LOAN,
        "SK_ID_BUREAU BIGINT, MONTHS_BALANCE INT, STATUS STRING",
    ),
    LoanTable("prev_app", "previous_application", PREVIOUS_LOAN),
    LoanTable("pos_cash", "POS_CASH_balance", PREVIOUS_LOAN),
    LoanTable("credit_card", "credit_card_balance", PREVIOUS_LOAN),
    LoanTable("installments", "installments_payments", PREVIOUS_LOAN),
)
TABLES: dict[str, LoanTable] = {t.name: t for t in _TABLES}


def parquet_path(root: str, name: str, pattern: str = "{stem}") -> str:
    """Location of a cleaned table; the pattern may use ``{stem}`` and ``{name}``."""
    return f"{root}/{pattern.format(stem=TABLES[name].stem, name=name)}"


def read_raw(
    spark: SparkSession,
    root: str,
    names: Iterable[str] = tuple(TABLES),
    null_token: str | None = "XNA",
    schemas: Mapping[str, StructType | str] | None = None,
) -> dict[str, DataFrame]:
    """The CSV tables. ``schemas`` (DDL or type, by table name) go before declared ones; a
    table with neither is inferred, which costs a scan."""
    given = {n: TABLES[n].schema for n in TABLES} | dict(schemas or {})
    return {n: read_csv(spark, f"{root}/{TABLES[n].stem}.csv", given[n], null_token) for n in names}


def read_cleaned(
    spark: SparkSession, root: str, names: Iterable[str] = tuple(TABLES), pattern: str = "{stem}"
) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(parquet_path(root, n, pattern)) for n in names}


def load_existing(
    spark: SparkSession, paths: Mapping[str, str]
) -> tuple[dict[str, DataFrame], list[str]]:
    """Tables that can be read, and the names of those whose path does not exist."""
    found, missing = {}, []
    for name, path in paths.items():
        try:
            found[name] = spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(name)
    return found, missing
