"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skyfold.session import discard, materialize


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of ``(a, b)`` with a > b: links each node's larger (or smaller) neighbours to its smallest one."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")) if large else joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return moved.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the smallest node of the component.

    Each round is two grouped joins over the links and ends in a written table, so hot nodes are partial sums plus
    a join whose large partitions Spark can split, and no component is ever in one place. Rounds grow with the
    logarithm of the longest chain. Self-links and repeated links change nothing; no links give no rows. A node
    whose only links are to itself has no row.
    """
    pairs = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = materialize(pairs, "links")
    while True:
        following = materialize(_stars(_stars(now, True), False), "links")
        discard(now)
        now = following
        lefts = now.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        chained = now.select(F.col("b").alias("a")).distinct().join(lefts.select("a"), "a", "left_semi").select(F.lit(1).alias("x"))
        if chained.union(lefts.where("n > 1").select(F.lit(1).alias("x"))).isEmpty():
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
