"""Connected components by alternating large-star and small-star steps on tables of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import Scratch


def _is_stars(edges: DataFrame) -> bool:
    """Whether every edge (u, v) leads from a node of one edge to a node without one of its own."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty()


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(node, label) for every end of an edge (u, v): label is the least node that it reaches.

    Each round rewires every node to the least of its neighbours (Kiveris and others, 2014), until only stars are left; the number of
    rounds grows with the logarithm of the longest path. Rows never exceed twice the edges. No row
    of the graph leaves the executors. The least neighbours are written
    tables, so that the edges of a node with very many of them can be dealt to several tasks.
    """
    now, turn = scratch.put(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), f"{name}_"), 0
    while not _is_stars(now):
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))
        low = scratch.put(low, f"{name}_low{turn}")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Now every row is (u, v) with v < u, and few have one u.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now = scratch.put(small, f"{name}_{turn}")
        scratch.drop(f"{name}_low{turn}", f"{name}_{turn - 1 if turn else ''}")
        turn += 1
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.union(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
