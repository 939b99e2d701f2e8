"""Connected components by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut


def _stars(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to its smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
    least = both.groupBy("hi").agg(F.min("lo").alias("m")).select("hi", F.least("hi", "m").alias("m"))
    return both.where(F.col("lo") > F.col("hi")).join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()


def _small_stars(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    linked = edges.join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return linked.unionByName(least.select("hi", F.col("m").alias("lo"))).where("hi <> lo").distinct()


def connected_components(edges: DataFrame, a: str, b: str, *, max_rounds: int = 100) -> DataFrame:
    """node, root for every node that has an edge to another; root is the smallest node of its component.

    Edges with a null end and edges from a node to itself link nothing. Only minima are aggregated, so a node with any number of
    edges is added up before the shuffle; each round ends in a reliable checkpoint. An empty table gives no rows.
    """
    x, y = F.col(a), F.col(b)
    now = cut(edges.where(x.isNotNull() & y.isNotNull() & (x != y)).select(F.greatest(x, y).alias("hi"), F.least(x, y).alias("lo")).distinct())
    mark = None
    for _ in range(max_rounds):
        now = cut(_small_stars(_stars(now)))
        found = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
        if tuple(found) == mark:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
        mark = tuple(found)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
