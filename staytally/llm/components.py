"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from staytally.llm.scratch import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    moved = both.join(least, "a").where("b > a")
    return moved.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of them. Edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every node with an edge (a, b) that is not its component's least.

    Each step moves edges by joins and map-side combined minima; no node's neighbours are
    ever gathered. A step's edges are landed, and the last but one are dropped.
    """
    edges = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    now = scratch.land(edges.distinct(), "edges")
    before = None
    while True:
        print_of = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if print_of == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = print_of
        after = scratch.land(_small_star(_large_star(now)), "edges")
        scratch.drop(now)
        now = after
