"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plateflow.session import cut


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node with an edge to another.

    Each round hooks every root onto its smallest neighbouring root, shortens the paths by pointer
    jumping and contracts the edges; the number of rounds grows with the logarithm of the graph.
    Every round is cut by a reliable checkpoint. Nothing is gathered but row counts.
    """
    live = cut(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a != b").distinct())
    roots = cut(live.select(F.col("a").alias("node")).union(live.select("b")).distinct().withColumn("root", F.col("node")))
    while True:
        both = live.union(live.select("b", "a"))
        hooks = cut(both.groupBy(F.col("a").alias("at")).agg(F.min("b").alias("to")).filter("to < at"))
        if hooks.isEmpty():
            return roots
        while True:
            onward = hooks.select(F.col("at").alias("to"), F.col("to").alias("next"))
            jumped = cut(hooks.join(onward, "to", "left").select(
                "at", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")))
            hooks = jumped.select("at", "to")
            if jumped.filter("moved").isEmpty():
                break
        known = hooks.select(F.col("at").alias("root"), "to")
        roots = cut(roots.join(known, "root", "left").select("node", F.coalesce("to", "root").alias("root")))
        moved = live.join(hooks.select(F.col("at").alias("a"), F.col("to").alias("to_a")), "a", "left").join(
            hooks.select(F.col("at").alias("b"), F.col("to").alias("to_b")), "b", "left")
        live = cut(moved.select(F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b"))
                   .filter("a != b").distinct())
