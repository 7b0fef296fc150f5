"""Connected components of an edge table, by alternating large-star and small-star.

Every step is an aggregate and a join on the node (a hot node's rows are
pre-aggregated, and its join is one that Spark can split); each round's edges
are written to the shared checkpoint folder, so a lost executor costs a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import cut_lineage, drop_stage


def _star(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v): every v and u get the smallest of u's group as neighbour."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = pairs.join(least, "u").select(F.col("v").alias("x"), "m")
    return joined.union(least.select(F.col("u").alias("x"), "m")).where("x <> m").distinct()


def _settled(stars: DataFrame) -> bool:
    """Every node has one root, and no root has a root."""
    ends = stars.select(F.col("x").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        stars.select("m", F.lit(0), F.lit(1)))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up > 1 or up = 1 and down = 1").isEmpty()


def connected(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` to ``(node, root)`` with the smallest node as root; nodes without edges are left out."""
    cur = edges.where("a <> b").select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("m"))
    before = None
    for _ in range(max_rounds):
        both = cur.select(F.col("x").alias("u"), F.col("m").alias("v")).union(cur.select(F.col("m").alias("u"), F.col("x").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        cur = cut_lineage(_star(large), "stars")
        if before is not None:
            drop_stage(before)
        before = cur
        if _settled(cur):
            return cur.select(F.col("x").alias("node"), F.col("m").alias("root")).union(
                cur.select("m", "m").distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
