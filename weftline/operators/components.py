"""Connected components by alternating large-star and small-star rounds.

Every round is two grouped minima and two equi-joins over the edge list, so a hub with millions of neighbours is
never gathered in one task: minima combine before the shuffle, and the joins can be split by adaptive execution.
Rounds grow with the logarithm of a component's size, not with its diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import staging


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node on an edge; component is the smallest node reachable.

    Edges are undirected; self-loops, repeated edges and nulls are ignored. No edges: an empty result.
    """
    a, b = F.col(src), F.col(dst)
    start = edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    now, seen = staging.put(start, "edges"), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == seen:
            break
        seen = mark
        new = staging.put(_small_star(_large_star(now)), "edges")
        staging.drop(now)
        now = new
    linked = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return linked.unionByName(roots)


def _large_star(e: DataFrame) -> DataFrame:
    """Join each larger neighbour of a node to the smallest neighbour of that node."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Join a node and its smaller neighbours to the smallest of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
