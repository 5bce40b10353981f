"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import cut_lineage


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (node, component): the smallest node that each node of the edges reaches.

    Large-star and small-star steps in turn: a node's larger neighbours, then its smaller
    ones, are tied to the smallest node of its neighbourhood, until every node hangs on its
    component's smallest. Each step is a written table. No step makes more edges than it
    gets, and the number of steps grows with the logarithm of the nodes.
    """
    edges = edges.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).filter("high <> low").distinct()
    edges = cut_lineage(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
        least = both.groupBy("high").agg(F.min("low").alias("least")).select("high", F.least("high", "least").alias("least"))
        # Large star: each node's larger neighbours to its least neighbour.
        large = both.join(least, "high").filter("low > high").select(F.col("low").alias("high"), F.col("least").alias("low"))
        large = large.filter("high <> low").distinct()
        # Small star: each node and its smaller neighbours to the least of them.
        smallest = large.groupBy("high").agg(F.min("low").alias("least"))
        small = large.join(smallest, "high")
        ties = small.select(F.col("low").alias("high"), F.col("least").alias("low")).unionByName(small.select("high", F.col("least").alias("low")))
        following = cut_lineage(ties.filter("high <> low").distinct())
        # Done when every edge ends at a node that is no edge's upper end.
        tops = following.select("low").distinct().join(following.select(F.col("high").alias("low")).distinct(), "low", "left_semi")
        one_each = following.groupBy("high").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        edges = following
        if tops.isEmpty() and one_each.isEmpty():
            break
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(
        edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    )
