"""Connected components by alternating star contraction, without gathering links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewatch.sources.tables import stage, unstage


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def components(links: DataFrame, staged_name: str = "components") -> DataFrame:
    """(node, root) for every node of ``links`` (u, v); the root is the least node of its component.

    Each round hangs the larger neighbours of a node, then the smaller ones, below the least: a
    component becomes a star after a number of rounds that grows with the logarithm of its size.
    A round counts nodes and roots; it ends when nothing has moved. Neighbours are never gathered:
    minima are combined before the shuffle, and Spark splits the joins of nodes with many links.
    """
    edges = stage(links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), staged_name)
    look = F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h"))
    seen = edges.select(look.alias("s")).first()["s"]
    while seen["n"]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = _least(large)
        down = large.join(least, "u")
        small = down.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        moved = stage(small.distinct(), staged_name)
        now = moved.select(look.alias("s")).first()["s"]
        unstage(edges)
        edges, same = moved, now == seen
        seen = now
        if same:
            break
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
