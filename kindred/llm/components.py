"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import stage, unstage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is linked to the smallest node around that node."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them; edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``: root is the smallest node it reaches.

    Nodes are longs; self-links, nulls and repeated or reversed links are allowed.  Nodes
    without a link don't appear.  Each round is written to the shared folder, the number of
    rounds grows with the logarithm of the longest chain, and a node with many links costs
    one partially aggregated row plus a join that splits skewed keys.
    """
    pairs = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    now = stage(pairs.filter("a <> b").distinct(), "links")
    seen = _print(now)
    while True:
        after = stage(_small_star(_large_star(now)), "links")
        unstage(now)
        now, last = after, seen
        seen = _print(now)
        if seen == last:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
