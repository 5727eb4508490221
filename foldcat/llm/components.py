"""Connected components of a graph of ids by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from foldcat.staging import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a node is linked to the least of the node and its neighbours."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its lesser neighbours are linked to the least of these."""
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = ordered.groupBy("a").agg(F.min("b").alias("low"))
    linked = ordered.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return linked.unionByName(least.select("a", F.col("low").alias("b"))).where("a != b")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least id that each node of ``edges`` (a, b) reaches.

    Nodes without an edge, and edges from a node to itself, give no row. Each round is a few joins on
    node ids and is kept in the shared folder; the number of rounds grows with the logarithm of the
    graph's width. The rounds end when every edge points at the least id of its component.
    """
    known = cut(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        state = known.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
        if state == before or not state.n:
            return known.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                known.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = state
        known = cut(_small_star(_large_star(known).distinct()).distinct())
