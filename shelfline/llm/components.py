"""Connected components of an edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import checkpointed


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Each node's neighbours (the larger ones, or the node and its smaller ones) point to the least of node and neighbours."""
    both = edges.union(edges.select("b", "a")) if larger else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    linked = both.join(least, "a")
    if larger:
        return linked.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m")).filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge, from edges (a, b) of longs; the root is the least node of its component.

    The number of rounds grows with the logarithm of the nodes. Each round is checkpointed in the shared folder and compared by
    its count and the sum of its edges' hashes.
    """
    now = checkpointed(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        mark = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == seen:
            break
        seen = mark
        now = checkpointed(_stars(_stars(now, True), False))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
