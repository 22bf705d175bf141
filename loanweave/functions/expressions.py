"""Scalar repairs as SQL text over SQL text (a quoted column or another repair).

A chain of repairs is parsed once per column, and the built-in expressions it names stay
inside code generation.
"""

from __future__ import annotations

import math


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    """Text literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def double(value: float) -> str:
    """Double literal."""
    return f"{float(value)!r}D" if math.isfinite(value) else f"double('{value}')"


def nullify(c: str, value: int) -> str:
    """A marker value becomes NULL; the type stays."""
    return f"nullif({c}, {value})"


def flip_positive(c: str) -> str:
    """Day offsets count backwards, so a positive one is negated."""
    return f"CASE WHEN {c} > 0 THEN -{c} ELSE {c} END"


def null_negative(c: str) -> str:
    return f"CASE WHEN {c} < 0 THEN NULL ELSE {c} END"


def fill(c: str, value: float, type_name: str) -> str:
    """The cast keeps an int column int."""
    return f"coalesce({c}, CAST({double(value)} AS {type_name}))"


def clip(c: str, lower: float, upper: float) -> str:
    """Pull outliers to the fences. NULL stays NULL, which least/greatest would not do."""
    low, high = double(lower), double(upper)
    return f"CASE WHEN {c} < {low} THEN {low} WHEN {c} > {high} THEN {high} ELSE {c} END"


def reset_outside(c: str, lower: float, upper: float, to: int = 0) -> str:
    return f"CASE WHEN {c} < {lower} OR {c} > {upper} THEN {to} ELSE {c} END"


def null_outside(c: str, lower: float, upper: float) -> str:
    return f"CASE WHEN {c} < {lower} OR {c} > {upper} THEN NULL ELSE {c} END"


def ratio(numerator: str, denominator: str) -> str:
    """Division by zero gives NULL, also under ANSI mode."""
    return f"try_divide({numerator}, {denominator})"


def indicator(condition: str) -> str:
    """1 where the condition holds, 0 where it is false or unknown."""
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def as_number(condition: str) -> str:
    """1, 0, or NULL where the condition is unknown."""
    return f"CAST({condition} AS INT)"


def comparable(c: str) -> str:
    """The value as double, with NaN treated as missing."""
    return f"nanvl(CAST({c} AS DOUBLE), CAST(NULL AS DOUBLE))"
