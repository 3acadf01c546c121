"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    moved = both.filter("v > u").join(least, "u")
    return moved.select(F.col("v").alias("u"), F.least("m", "u").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them. ``u > v`` holds."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def label_components(links: DataFrame, label: str) -> DataFrame:
    """``(node, root)`` for every node of ``links (u, v)`` but the roots, which are the smallest
    nodes of their components. Rounds are logarithmic in the longest path; each ends in a written
    table, and only counts come to the driver. Loops and repeated links are ignored."""
    edges = stage(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{label}-edges"
    )
    state = None
    while True:
        edges = stage(_small_star(_large_star(edges)), f"{label}-edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
