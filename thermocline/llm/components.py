"""Connected components by alternating large-star and small-star over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from thermocline.llm.storage import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the least of the node and its neighbours."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("least"))
    return both.where("b > a").join(least, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    rest = down.join(least.withColumnRenamed("a", "node"), F.col("a") == F.col("node")).where("b <> least").select("b", F.col("least"))
    return rest.toDF("a", "b").union(least.select("a", F.col("least").alias("b")))


def components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """Columns node, component (the least node reachable) of every node that some edge (a, b) names.

    Edges are integers, in any direction, repeated or not; loops count as nodes. Neighbours are
    never gathered: a step takes minima by node, combined before the shuffle, and joins them back,
    where adaptive execution splits the rows of a hub. The driver sees two numbers a round.
    """
    names = edges.columns
    edges = stored(edges.toDF("a", "b"), "edges") if names else edges
    loops = edges.where("a = b").select("a")
    now = edges.where("a <> b")
    mark = None
    for _ in range(limit):
        now = stored(_small_star(_large_star(now).distinct()).distinct(), "stars")
        row = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    else:
        raise RuntimeError(f"components have not settled in {limit} rounds")
    heads = now.select(F.col("b").alias("a")).union(loops).distinct().join(now.select(F.col("a").alias("known")), F.col("a") == F.col("known"), "left_anti")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(heads.select("a", "a"))
