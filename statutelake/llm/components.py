"""Distributed connected components by alternating large-star and small-star.

Every step is an aggregation and a join over the edges, so that no component is
ever gathered in one place. Each round is written to the shared folder: lineage
stays short and lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .session import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them. Edges go from large to small."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from each node that has a link.

    Nodes without links do not occur. Links of a node to itself, repeated links
    and links with a null end have no effect. No links give no rows.
    """
    links = edges.select(F.col(a).cast("long").alias("x"), F.col(b).cast("long").alias("y")).filter("x != y")
    now = written(links.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "edges")
    before = None
    while True:
        # A fixed point: the same number of edges with the same sums.
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = state
        now = written(_small_star(_large_star(now).distinct()).distinct(), "edges")
