"""Connected components of a large edge table, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns ``a``, ``b``);
    ``component`` is the smallest node reachable.

    Each round is two grouped minima and two joins over the edge table, which
    never grows; rounds follow the logarithm of the diameter.  Ends when the
    edges are stars around smallest nodes.  ``edges`` may repeat pairs and hold
    loops.  A hub's edges stay spread: the minima aggregate before the shuffle
    and the joins can be split by AQE.
    """
    both = edges.filter(F.col("a") != F.col("b"))
    now = written(both.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc-edges")
    for _ in range(max_rounds):
        # large star: every larger neighbour of u goes to the smallest of u and its neighbours
        sym = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sym.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = sym.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        large = large.distinct()
        # small star: every smaller neighbour of u, and u, go to the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        after = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc-edges")
        # done once no node on the right stands on the left (stars only) and each node has one edge
        rights = after.select(F.col("v").alias("u")).distinct()
        repeated = after.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1")
        now = after
        if after.join(rights, "u", "left_semi").isEmpty() and repeated.isEmpty():
            break
    else:
        raise RuntimeError(f"components still open after {max_rounds} rounds")
    centres = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(centres)
