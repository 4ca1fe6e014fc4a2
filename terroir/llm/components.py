"""Connected components by alternating large-star and small-star steps of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.storage import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least node around that node."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them. Edges point from larger to smaller nodes."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """``node`` and ``root``, the least node reachable, for each node of ``edges`` (longs a, b) that is not a root.

    Each step joins edges with one least neighbour per node, so a hub is one row on one side and split by skew
    handling on the other. Steps end when the edges no longer change, which the driver sees as two numbers.
    """
    down = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(down.distinct(), name)
    last = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        last = state
        edges = written(_small_star(_large_star(edges)), name)
