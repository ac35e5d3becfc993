"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from movecheck.sources.sinks import saved


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = saved(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "stars")
    tied = both.join(least, "a").filter("b > a").select(F.col("b").alias("b"), F.col("m").alias("a"))
    return tied.select("a", "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = saved(down.groupBy("u").agg(F.min("v").alias("m")), "stars")
    tied = down.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    own = least.select(F.col("m").alias("a"), F.col("u").alias("b"))
    return tied.unionByName(own).filter("a < b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """For every node that an edge touches: node, and root, the smallest reachable.

    Edges are pairs (a, b) of numbers, in either order; loops and repeats do no
    harm. Each round is written to the shared scratch space. Raises if the stars
    have not settled after ``max_rounds`` (the needed rounds grow with the
    logarithm of the largest component).
    """
    ordered = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    stars, before = saved(ordered.distinct(), "stars"), None
    for _ in range(max_rounds):
        stars = saved(_small_star(saved(_large_star(stars), "stars")), "stars")
        mark = stars.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if mark == before:
            roots = stars.select(F.col("a").alias("node")).distinct().select("node", F.col("node").alias("root"))
            return stars.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(roots)
        before = mark
    raise RuntimeError(f"components have not settled after {max_rounds} rounds")
