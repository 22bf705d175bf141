"""Connected components of a graph of links, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweave.sources.staging import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked to its smallest neighbour instead."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, are linked to its smallest neighbour."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (bigint ``u`` and ``v``): root is the smallest node.

    Alternates two kinds of star until nothing changes; the number of rounds grows with the
    logarithm of the size of a component. Each round's edges, at most one per node and link,
    are written to the shared folder, so lost executors repeat one round at most. Edges from
    a node to itself are ignored; repeated edges count once.
    """
    now = stage(edges.where("u != v").select("u", "v").distinct(), "links")
    sign = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    seen = sign(now)
    while True:
        now = stage(_small_star(_large_star(now)), "links")
        found = sign(now)
        if found == seen:
            break
        seen = found
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select("v", F.col("v").alias("root")).distinct().toDF("node", "root")
    )
