"""From raw CSV tables to cleaned Parquet tables, with verification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from loanweave.functions.roles import matching
from loanweave.operators import checks
from loanweave.operators.cleaning import CleaningSpec, clean
from loanweave.plans import cleaning_presets as presets
from loanweave.sources.readers import read_csv, rejected_cells
from loanweave.sources.staging import staged
from loanweave.sources.tables import TABLES, load_existing, parquet_path, read_raw
from loanweave.sources.writers import write_counted

# Columns of the loan data that are more than 60 % empty.
_APPLICATION = (
    "COMMONAREA_AVG",
    "COMMONAREA_MODE",
    "COMMONAREA_MEDI",
    "NONLIVINGAPARTMENTS_AVG",
    "NONLIVINGAPARTMENTS_MODE",
    "NONLIVINGAPARTMENTS_MEDI",
    "FONDKAPREMONT_MODE",
    "LIVINGAPARTMENTS_AVG",
    "LIVINGAPARTMENTS_MODE",
    "LIVINGAPARTMENTS_MEDI",
    "FLOORSMIN_AVG",
    "FLOORSMIN_MODE",
    "FLOORSMIN_MEDI",
    "YEARS_BUILD_AVG",
    "YEARS_BUILD_MODE",
    "YEARS_BUILD_MEDI",
    "OWN_CAR_AGE",
)
EXPECTED_DROPPED: dict[str, Sequence[str]] = {
    "app_train": _APPLICATION,
    "app_test": _APPLICATION,
    "bureau": ("AMT_CREDIT_MAX_OVERDUE", "AMT_ANNUITY"),
    "prev_app": ("RATE_INTEREST_PRIMARY", "RATE_INTEREST_PRIVILEGED", "NAME_PRODUCT_TYPE", "DAYS_FIRST_DRAWING"),
}
# Rows and columns of each cleaned table.
EXPECTED_SHAPE: dict[str, tuple[int, int]] = {
    "app_train": (307511, 105),
    "app_test": (48744, 104),
    "bureau": (1716428, 15),
    "bureau_bal": (27299925, 3),
    "prev_app": (1670214, 33),
    "pos_cash": (10001358, 8),
    "credit_card": (3840312, 23),
    "installments": (13605401, 8),
}
NULLS_ACCEPTABLE = ("app_train", "app_test", "prev_app")
DAYS_CHECKED = ("app_train", "app_test", "bureau", "prev_app", "installments")


def clean_application_csv(spark: SparkSession, source: str, target: str) -> int:
    """The basic contract on one CSV file. Returns the number of rows written."""
    with staged(read_csv(spark, source), "raw") as raw:
        return write_counted(clean(raw, presets.basic_application()), target)


def clean_all(
    spark: SparkSession,
    raw_root: str,
    clean_root: str,
    specs: Mapping[str, CleaningSpec] | None = None,
    pattern: str = "{stem}",
    schemas: Mapping[str, str] | None = None,
) -> dict[str, int]:
    """Clean every table under the thorough contract. Returns rows written per table.

    CSV text is parsed once: each raw table is staged as Parquet, and the fitting scans
    read only the columns they need from there. ``schemas`` (DDL by table name) spare the
    scan that infers types.
    """
    written = {}
    for name, spec in (specs or presets.thorough()).items():
        with staged(read_raw(spark, raw_root, [name], schemas=schemas)[name], f"raw-{name}") as raw:
            written[name] = write_counted(clean(raw, spec), parquet_path(clean_root, name, pattern))
    return written


def clean_and_check(
    spark: SparkSession,
    raw_root: str,
    clean_root: str,
    specs: Mapping[str, CleaningSpec] | None = None,
    pattern: str = "{stem}",
    schemas: Mapping[str, str] | None = None,
    null_token: str = "XNA",
) -> DataFrame:
    """As ``clean_all``, and the check rows of every table, taken while it is written. Tables
    with a schema (declared, or from ``schemas``) are also checked for cells it cannot read.
    Runs in a new session, see ``write_observed``."""
    spark, found = spark.newSession(), []
    for name, spec in (specs or presets.thorough()).items():
        kind = (schemas or {}).get(name) or TABLES[name].schema
        if kind:
            lost = rejected_cells(spark, f"{raw_root}/{TABLES[name].stem}.csv", kind, null_token)
            found.append(checks.cells_readable(lost, name))
        with staged(read_raw(spark, raw_root, [name], null_token, schemas)[name], f"raw-{name}") as raw:
            found.append(write_checked({name: clean(raw, spec)}, {name: parquet_path(clean_root, name, pattern)}))
    return checks.combine(*found)


def verify(
    spark: SparkSession,
    clean_root: str,
    pattern: str = "{stem}",
    dropped: Mapping[str, Sequence[str]] = EXPECTED_DROPPED,
    shapes: Mapping[str, tuple[int, int]] = EXPECTED_SHAPE,
    acceptable: Sequence[str] = NULLS_ACCEPTABLE,
) -> DataFrame:
    """All check rows for the cleaned tables on disk; feed to ``checks.verdict``."""
    paths = {n: parquet_path(clean_root, n, pattern) for n in TABLES}
    tables, missing = load_existing(spark, paths)
    rows = [checks.loaded(spark, list(paths), missing)]
    return checks.combine(*rows, *check_tables(tables, dropped, shapes, acceptable))


def checks_of(
    name: str,
    df: DataFrame,
    dropped: Mapping[str, Sequence[str]] = EXPECTED_DROPPED,
    shapes: Mapping[str, tuple[int, int]] = EXPECTED_SHAPE,
    acceptable: Sequence[str] = NULLS_ACCEPTABLE,
    days: Sequence[str] = presets.DAYS,
    employed: str = "DAYS_EMPLOYED",
) -> list[Sequence[str]]:
    """The checks that apply to a cleaned table."""
    offsets = matching(df.columns, days)
    found = [checks.nulls_acceptable(df, name in acceptable)]
    if name in ("app_train", "app_test"):
        found += [checks.sentinel_gone(df, [employed]), checks.remaining_nulls(df, [employed])]
    if name == "prev_app":
        found.append(checks.sentinel_gone(df, offsets))
    if name in DAYS_CHECKED:
        found.append(checks.days_not_positive(offsets, (employed,)))
    if name in dropped:
        found.append(checks.columns_dropped(df, dropped[name]))
    if name in shapes:
        found.append(checks.expected_shape(df, *shapes[name]))
    return found


def check_tables(tables: Mapping[str, DataFrame], *expected, **named) -> list[DataFrame]:
    """Check rows, from one scan per table; further arguments as for ``checks_of``."""
    return [checks.run(df, name, *checks_of(name, df, *expected, **named)) for name, df in tables.items()]


def write_checked(tables: Mapping[str, DataFrame], paths: Mapping[str, str], *expected, **named) -> DataFrame:
    """Write the cleaned tables and return their check rows, taken by the writing tasks. See
    ``write_observed`` for the session that the tables should belong to."""
    return checks.combine(*(checks.on_write(df, paths[name], name, *checks_of(name, df, *expected, **named)) for name, df in tables.items()))
