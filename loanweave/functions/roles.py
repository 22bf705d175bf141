"""Choosing columns by type family, name pattern or presence."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from fnmatch import fnmatchcase

from pyspark.sql import types as T

# Which Spark types count as "numeric" for a given rule.
FAMILIES: dict[str, tuple[type[T.DataType], ...]] = {
    "any": (T.NumericType,),
    "plain": (T.IntegerType, T.LongType, T.FloatType, T.DoubleType),
    "int_double": (T.IntegerType, T.DoubleType),
}


def numeric_columns(
    schema: T.StructType, family: str = "plain", exclude: Iterable[str] = ()
) -> list[str]:
    skip = set(exclude)
    kinds = FAMILIES[family]
    return [f.name for f in schema if f.name not in skip and isinstance(f.dataType, kinds)]


def text_columns(schema: T.StructType, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in schema if f.name not in skip and isinstance(f.dataType, T.StringType)]


def matching(columns: Sequence[str], patterns: Iterable[str]) -> list[str]:
    """Columns named by ``patterns`` (``DAYS_*`` or exact), in table order.

    Names that the table does not have are skipped: earlier steps may have
    dropped them.
    """
    wanted = tuple(patterns)
    return [c for c in columns if any(fnmatchcase(c, p) for p in wanted)]
