"""Connected components of an edge table, by alternating star contractions in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest node around it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie every smaller neighbour of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``u, v``): the smallest node reachable.

    Each round is two minimum aggregations and joins over the remaining edges (a hub's edges meet its minimum in
    a join that adaptive execution can split); the number of rounds is logarithmic in the longest chain.  The
    edges of a round are checkpointed to the shared folder; only two sums reach the driver."""
    now, before = cut_lineage(edges.filter("u != v").distinct()), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        now = cut_lineage(_small_star(_large_star(now)))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
