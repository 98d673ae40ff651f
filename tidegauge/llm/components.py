"""Connected components by repeated smallest-label exchange with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.arrow import cut


def components(edges: DataFrame) -> DataFrame:
    """Rows of ``(node, root)`` for the nodes of edges ``(a, b)``; the root is the smallest node.

    Each round links every node to the smallest of its neighbourhood and then its larger
    neighbours to that one (large star), and points nodes at the smallest of what they point at
    (small star), until no edge changes. Edges are pre-aggregated before each shuffle and never
    gathered: a hub's neighbours meet only in a minimum and in joins that can be split. The number
    of rounds grows with the logarithm of a component's width. Empty edges give no rows.
    """
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    edges = cut(edges.where("a <> b").select(low, high).distinct())
    known = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: neighbours above a node go to the smallest of its neighbourhood
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("m").alias("a"), F.col("v").alias("b"))
            .distinct()
        )
        # small star: what a node points down at goes to the smallest of it, and so does the node
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (
            large.join(down, "b")
            .select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y"))
            .where("x <> y")
            .select(F.col("x").alias("a"), F.col("y").alias("b"))
            .distinct()
        )
        edges = cut(small)
        # done when every node above a root points at just one root and no root points down
        state = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"),
        ).first()
        if state == known:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
                edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            )
        known = state
