"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least node among the neighbours and the node."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the least of them. Here ``u > v`` on all edges."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of an edge, root being the least node it is connected with.

    Both star steps keep the components and shorten the paths; when a round changes nothing, every edge goes straight
    to its root. Rounds grow with the logarithm of the longest path. Each round is written to the
    shared folder, so lost executors repeat one round at most.
    """
    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    now = scratch.keep(now, "edges0")
    mark = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before, k = mark(now), 0
    while before[0]:
        k += 1
        now = scratch.keep(_small_star(_large_star(now)), f"edges{k}")
        scratch.release(f"edges{k - 1}")
        after = mark(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v"), F.col("v")).distinct())
