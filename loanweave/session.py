"""The one place a session is built; every operator takes what it is given."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(app_name: str = "loanweave", **conf: str) -> SparkSession:
    """Session with adaptive execution on; ``conf`` keys use ``__`` for dots.

    Memory, master and shuffle partition counts belong to the deployment
    (``spark-submit``), so none is fixed here.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
