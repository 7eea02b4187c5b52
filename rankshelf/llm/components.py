"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rankshelf.session import stage, unstage


def _normal(edges: DataFrame) -> DataFrame:
    """Distinct edges with the larger end first, loops dropped."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; the root is the smallest node reachable.

    Every round is a large-star step (larger neighbours move to the smallest
    neighbour) and a small-star step (the node and its smaller neighbours move to
    the smallest). Rounds grow with the logarithm of the component size, edges
    never grow in number beyond the first round's, and each round is written to
    the checkpoint folder. A hot centre is met in equi-joins whose edge side AQE
    can split; the minima are summed map-side. The rounds end when the edge set
    no longer changes (a count and a hash sum, one row).
    """
    current, seen = stage(_normal(edges), "edges"), None
    while True:
        state = current.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == seen:
            break
        seen = state
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(current.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lowest, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        following = stage(moved.select("e.*").where("a <> b").distinct(), "edges")
        unstage(current)
        current = following
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
