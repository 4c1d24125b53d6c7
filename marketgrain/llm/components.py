"""Connected components by alternating large and small stars (Kiveris et al., 2014).

Every step is a group minimum and a join, so no task holds a component: a hub's neighbours are joined with the
hub's minimum, and large partitions of such joins are split by adaptive execution. Each step's edges are written to
the shared folder, which cuts the lineage and survives lost executors. Only two truth values a step reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketgrain.llm.scratch import stored


def connected(edges: DataFrame) -> DataFrame:
    """Nodes of ``edges`` (a, b) with the smallest node that they reach. Null ends and loops are left out."""
    edges = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, "edges")
    while not _stars(edges):
        edges = stored(_small_star(_large_star(edges)), "edges")
    # a star around each component's minimum is left
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.union(edges.select(F.col("b"), F.col("b")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether the larger end of each edge has no other edge, so that every component is a star around its minimum."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where((F.col("up") > 1) | (F.col("up") > 0) & (F.col("down") > 0)).isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are tied to the smallest in its neighbourhood."""
    both = edges.union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    tied = both.where(F.col("b") > F.col("a")).join(least, "a")
    # at most one row an edge; what repeats goes in the small star
    return tied.select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.where(F.col("a") != F.col("b")).union(least.select("a", F.col("m").alias("b"))).distinct()
