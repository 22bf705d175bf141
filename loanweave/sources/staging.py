"""Tables written once and read back, to cut lineage or to reuse a costly result.

They go to the shared folder that the cluster names in ``spark.checkpoint.dir``, so they
outlive any executor; where that is unset, to the warehouse, which is shared as well. Each
application has a folder of its own there. ``staged`` removes one copy after use, ``scratch``
what a block has staged once its result is written, ``release`` all of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ROW_OVERHEAD = 32
_blocks: list[list[str]] = []  # paths handed out in the open ``scratch`` blocks


def staging_root(spark: SparkSession) -> str:
    """Folder of this application; settings are only read."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/loanweave-{spark.sparkContext.applicationId}"


def staging_path(spark: SparkSession, label: str, keep: bool = False) -> str:
    """A path not used before. With ``keep``, a ``scratch`` block leaves it."""
    path = f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"
    if _blocks and not keep:
        _blocks[-1].append(path)
    return path


def stage(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` and return it as a plain Parquet scan. ``keep`` as for ``staging_path``."""
    path = staging_path(df.sparkSession, label, keep)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """As ``stage``, for a copy that is needed only inside the block and removed after it."""
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        _remove(spark, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes at the end of the block what was staged in it, but for what was staged with ``keep``.

    For a caller that writes the result of an operator inside the block: operators return
    tables that read what they have staged, so they cannot remove it themselves.
    """
    _blocks.append([])
    try:
        yield
    finally:
        for path in _blocks.pop():
            _remove(spark, path)


def release(spark: SparkSession) -> None:
    """Removes all that this application has staged. Tables read from there can no longer be used."""
    _remove(spark, staging_root(spark))


def stage_all(dfs: Sequence[DataFrame], label: str) -> list[DataFrame]:
    """Stage several results as concurrent jobs, so that short stages share the cluster, and
    measure all of them in one more. What was staged like this before is taken as it is."""
    with ThreadPoolExecutor(max_workers=max(len(dfs), 1)) as pool:
        out = list(pool.map(lambda df: df if hasattr(df, "_staged_bytes") else stage(df, label), dfs))
    fresh = [df for df in out if not hasattr(df, "_staged_bytes")]
    for df, size in zip(fresh, _sizes(fresh)):
        df._staged_bytes = size
    return out


def stage_measured(df: DataFrame, label: str) -> DataFrame:
    return stage_all([df], label)[0]


def _variable(df: DataFrame) -> list[str]:
    fixed = (T.NumericType, T.DatetimeType, T.BooleanType)
    return [f.name for f in df.schema if not isinstance(f.dataType, fixed)]


def _sizes(dfs: Sequence[DataFrame]) -> list[int]:
    """Sizes in memory, from one job: rows (from file footers, if all columns are of fixed
    width) times row width, plus the length of the variable columns."""
    if not dfs:
        return []
    rows = []
    for i, df in enumerate(dfs):
        width = F.count(F.lit(1)) * (_ROW_OVERHEAD + 8 * len(df.columns))
        lengths = [F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`").cast("string"))), F.lit(0)) for c in _variable(df)]
        rows.append(df.agg(sum(lengths, width).alias("bytes")).select(F.lit(i).alias("i"), "bytes"))
    found = {r["i"]: r["bytes"] for r in reduce(DataFrame.union, rows).collect()}
    return [found[i] for i in range(len(dfs))]


def measured_bytes(df: DataFrame) -> int:
    known = getattr(df, "_staged_bytes", None)
    return known if known is not None else _sizes([df])[0]
