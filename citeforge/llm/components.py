"""Connected components by alternating large-star and small-star steps over staged link tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, staged


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, comp) of every linked node: comp is the least node it can reach. Nodes are longs; only links are stored.

    Every step groups by node with partial aggregation and joins staged tables, so hot nodes are split by AQE; the
    number of rounds grows with the logarithm of the longest path. Nothing but counts reaches the driver.
    """
    edges = staged(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct(), "cc-links")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        # large star: larger neighbours hang on the least one
        large = staged(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct(), "cc-large")
        low2 = large.groupBy("a").agg(F.min("b").alias("low"))
        # small star: smaller neighbours, and the node itself, hang on the least one
        hung = large.join(low2, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(low2.select("a", F.col("low").alias("b")))
        new = staged(hung.where("a <> b").distinct(), "cc-links")
        discard(edges, large)
        edges = new
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(roots)


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one node only, which hangs on none (a is the larger node of each link)."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    met = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return met.where("up > 1 or up = 1 and down = 1").isEmpty()
