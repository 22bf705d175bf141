"""Aggregate measures as SQL text, so that a roll-up can be declared as data.

A double sum depends on the order in which partitions are merged, so it can change between
two runs or after a lost executor. ``scale`` on a sum or mean rules that out:

- a number of decimal places adds the values up as whole numbers of such units. A value with
  more decimals, or too large to be counted in them, fails the job; nothing is rounded away
  but what a product of doubles can be off, 1e-6 of a unit, or 1e-14 of a larger value;
- ``ANY`` suits doubles of unknown scale: the bits of each value are dealt to fixed bins of
  26 bits, from 2^63 down to 2^-66, which add up as whole numbers. Bits below that are cut
  off, value by value; a value of 2^64 or more, or not finite, is added as a double.

Every measure combines on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from loanweave.functions.expressions import quoted, text

ANY = "any"
Scale = int | str | None

_PART = 1_000_000
# Bits of a bin, bins, and the exponent of the first; 2^36 values of a group fit its sums.
_BIN, _BINS, _TOP = 26, 5, 38


def _binned(column: str) -> list[str]:
    value = f"CAST({column} AS DOUBLE)"
    inside = f"CASE WHEN abs({value}) < {2.0**64!r}D THEN {value} END"
    rest, parts = f"({inside} * {2.0**-_TOP!r}D)", []
    for _ in range(_BINS):
        whole = f"CAST({rest} AS BIGINT)"  # towards zero, so that what is left is exact for either sign
        parts.append(f"sum({whole})")
        rest = f"(({rest} - {whole}) * {2.0**_BIN!r}D)"
    return [*parts, f"sum(CASE WHEN abs({value}) < {2.0**64!r}D THEN NULL ELSE {value} END)"]


def _from_bins(parts: Sequence[str], n: str) -> str:
    # Carries go up first, so that every bin but the top one holds 26 bits and is exact as a double.
    *bins, odd = parts
    carried, terms = None, []
    for k in reversed(range(_BINS)):
        whole = f"coalesce({bins[k]}, 0L)" + (f" + shiftright({carried}, {_BIN})" if carried else "")
        kept = f"({whole})" if k == 0 else f"(({whole}) & {2**_BIN - 1}L)"
        terms.append(f"{kept} * {2.0 ** (_TOP - _BIN * k)!r}D")
        carried = f"({whole})"
    total = " + ".join(reversed(terms))  # from the top down: what cancels is exact
    return f"CASE WHEN {n} > 0 THEN {total} + coalesce({odd}, 0D) END"


def _units(column: str, scale: int) -> list[str]:
    # Two long sums, of the high and the low part of each value, so that no group is too
    # large for them; put together as a decimal at the end.
    value = f"CAST({column} * {10**scale}D AS DOUBLE)"
    refused = text(f"{column} has values that are not exact to {scale} decimals")
    unit = (
        f"CASE WHEN {column} IS NULL THEN NULL WHEN abs({value} - rint({value})) <= greatest(1e-6D, abs({value}) * 1e-14D)"
        f" THEN CAST(rint({value}) AS BIGINT) ELSE CAST(raise_error({refused}) AS BIGINT) END"
    )
    return [f"sum({unit} div {_PART})", f"sum({unit} % {_PART})"]


def sum_parts(column: str, scale: Scale) -> list[str]:
    """Sums that make up the sum of a column, so that they can be added up in several steps."""
    c = quoted(column)
    if scale is None:
        return [f"sum({c})"]
    return _binned(c) if scale == ANY else _units(c, scale)


def sum_of(parts: Sequence[str], n: str, scale: Scale) -> str:
    """The sum, from the values of ``sum_parts`` and the number of values."""
    if scale is None:
        return parts[0]
    if scale == ANY:
        return _from_bins(parts, n)
    return f"(CAST(CAST({parts[0]} AS DECIMAL(20,0)) * {_PART} + {parts[1]} AS DOUBLE) / {10**scale}D)"


def count(column: str) -> str:
    return f"count({quoted(column)})"


def total(column: str, scale: Scale = None) -> str:
    return sum_of(sum_parts(column, scale), count(column), scale)


def mean(column: str, scale: Scale = None) -> str:
    return f"avg({quoted(column)})" if scale is None else f"try_divide({total(column, scale)}, {count(column)})"


def count_equal(column: str, value: str) -> str:
    return f"count_if({quoted(column)} = {text(value)})"


def count_positive(column: str) -> str:
    return f"count_if({quoted(column)} > 0)"


# Codes of I, N, i, n (as in Infinity, NaN) and DEL, which a cast trims like other controls.
_LETTERS = "73, 78, 105, 110, 127"


def text_number(column: str) -> str:
    """The number that a text reads as, else NULL.

    A failing cast is slow, so text whose first character rules a number out is not cast:
    digits, signs, point and blanks all come before ``:`` (58).
    """
    c = quoted(column)
    return (
        f"CASE WHEN ascii({c}) <= 57 OR ascii({c}) IN ({_LETTERS})"
        f" THEN try_cast({c} AS DOUBLE) END"
    )


def text_mean(column: str) -> str:
    """Mean of the values that read as numbers; other text counts as missing."""
    return f"avg({text_number(column)})"


def text_sum(column: str) -> str:
    return f"sum({text_number(column)})"


def text_count(column: str) -> str:
    return f"count({text_number(column)})"
