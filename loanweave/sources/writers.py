"""Sinks: Parquet, CSV, feature vectors and fitted models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation


def write_parquet(df: DataFrame, path: str, compression: str = "snappy") -> None:
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def write_observed(df: DataFrame, path: str, *metrics: Column) -> dict[str, object]:
    """Write, and return aggregates over the rows written, which the writing tasks take in passing.

    ``df`` should belong to a session of its own (``spark.newSession()``): once a session has
    observed, Spark 4.1 cannot send models that MLlib fits in it to tasks any more.
    """
    seen = Observation()
    write_parquet(df.observe(seen, *metrics), path)
    return seen.get


def write_counted(df: DataFrame, path: str) -> int:
    """Write, then count what was written: file footers only, not the lineage again."""
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def write_csv(df: DataFrame, path: str, null_token: str | None = None) -> None:
    writer = df.write.mode("overwrite").option("header", True)
    if null_token is not None:
        writer = writer.option("nullValue", null_token)
    writer.csv(path)


def write_features(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Identifier, label and feature vector only."""
    write_parquet(df.select(*columns), path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
