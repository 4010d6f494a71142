"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(a long, b long) edges -> (node long, root long): `root` is the smallest node reachable; every node
    of an edge has one row.

    Each round replaces edges by edges to smaller neighbours and writes the new table to the shared folder, so
    nothing is gathered in one place and a lost executor repeats one round at most.  A node with many
    neighbours costs partial minima before the shuffle and a join that AQE may split.
    """
    both = edges.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
    edges = written(both.distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        # large star: every larger neighbour of a node joins the smallest of the node and its neighbours
        out = edges.select(F.col("v").alias("x"), F.col("u").alias("y")).unionByName(
            edges.select(F.col("u").alias("x"), F.col("v").alias("y")))
        least = out.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = out.filter("y > x").join(least, "x").select(F.col("y").alias("v"), F.col("m").alias("u")).distinct()
        # small star: a node and its smaller neighbours join the smallest of them
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).filter("v <> u").unionByName(
            low.select("v", F.col("m").alias("u"))).distinct()
        edges = written(small, "edges")
        # every node is in one star once no node has both a smaller and a larger neighbour
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
                edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
