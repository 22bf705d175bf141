"""CSV and Parquet scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    null_token: str | None = None,
) -> DataFrame:
    """CSV with a header.

    With ``null_token``, that token and an empty unquoted field are NULL. With a schema
    the header is checked against it; without one the types are inferred from the whole
    file, so at scale infer once (``infer_schema``) and pass the result.
    """
    reader = spark.read.option("header", True)
    if null_token is not None:
        reader = reader.option("nullValue", null_token)
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def infer_schema(
    spark: SparkSession, path: str, null_token: str | None = None
) -> T.StructType:
    return read_csv(spark, path, None, null_token).schema


def rejected_cells(
    spark: SparkSession, path: str, schema: T.StructType | str, null_token: str | None = None
) -> DataFrame:
    """``(column, rejected, rows)``: cells with text that the declared type of their column cannot read.

    ``read_csv`` turns such a cell into NULL. One scan; only the lines that Spark reports as
    broken are looked at again, cell by cell. A line with too few or too many cells is broken
    as well, but counts only by the cells that are there and cannot be read.
    """
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    names, broken = kind.names, "_broken"
    while broken in names:
        broken = f"_{broken}"
    options = {"header": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    if null_token is not None:
        options["nullValue"] = null_token
    lines = spark.read.options(**options).schema(T.StructType([*kind.fields, T.StructField(broken, T.StringType())])).csv(path)
    as_text = ", ".join(f"`{n}` STRING" for n in names)
    raw = F.from_csv(F.col(f"`{broken}`"), as_text, {k: v for k, v in options.items() if k == "nullValue"}).alias("raw")
    both = lines.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("read"), raw)
    lost = [F.count_if(F.col(f"raw.`{n}`").isNotNull() & F.col(f"read.`{n}`").isNull()).alias(f"c{i}") for i, n in enumerate(names)]
    groups = F.pmod(F.spark_partition_id(), F.lit(64)).alias("group")
    counted = both.groupBy(groups).agg(F.count(F.lit(1)).alias("rows"), *lost).drop("group")
    cells = F.array(*[F.struct(F.lit(n).alias("column"), F.col(f"c{i}").alias("rejected"), "rows") for i, n in enumerate(names)])
    parts = counted.select(F.inline(cells)).groupBy("column").agg(F.sum("rejected").alias("rejected"), F.sum("rows").alias("rows"))
    every = spark.createDataFrame([(n,) for n in names], "column STRING")
    return every.join(parts, "column", "left").na.fill(0)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
