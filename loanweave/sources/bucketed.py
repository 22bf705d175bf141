"""Tables stored in buckets of a key, so that repeated joins and roll-ups on it shuffle nothing.

A bucketed table is Parquet in a folder of its own; the layout (key and number of buckets) is
known to the session's catalog only, so another session registers the folder again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from loanweave.functions.expressions import quoted


def store_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` in ``buckets`` sorted buckets of ``key`` to ``path`` as ``table``, and return it.

    Rows are dealt by the key first, so that each bucket is one file. A bucket holds all rows
    of its keys: choose the key of a table where none holds a large share of the rows.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def open_bucketed(spark: SparkSession, table: str, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """Register a folder that ``store_bucketed`` wrote, with the same key and number of buckets."""
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {quoted(table)}")
    spark.sql(
        f"CREATE TABLE {quoted(table)} ({columns}) USING parquet"
        f" CLUSTERED BY ({quoted(key)}) SORTED BY ({quoted(key)}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table)
