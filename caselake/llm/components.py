"""Connected components of a link table, by alternating star contractions on staged tables.

Each round links every larger neighbour of a node to the node's smallest neighbour (large star), then
every smaller neighbour (small star), until the links are stars: a logarithmic number of rounds in
practice.  No link ever reaches the driver; a node with very many links meets only partial
minima and joins of written tables, which adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_staged, stage


def _are_stars(links: DataFrame) -> bool:
    """Is every node either one link's larger end or only a smaller end?"""
    ends = links.select(F.col("a").alias("u"), F.lit(0).alias("up")).unionAll(links.select(F.col("b").alias("u"), F.lit(1).alias("up")))
    seen = ends.groupBy("u").agg(F.sum("up").alias("ups"), F.min("up").alias("low"))
    return seen.where("ups > 1 or (ups = 1 and low = 0)").isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b) that isn't its component's smallest one."""
    pair = F.struct(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    current = stage(links.where("a <> b").select(pair.alias("p")).select("p.a", "p.b").distinct(), "links")
    while not _are_stars(current):
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(current.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = stage(both.join(low, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct(), "large")
        low_of = stage(large.groupBy("b").agg(F.min("a").alias("m")), "low")
        moved = large.join(low_of, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        small = stage(moved.unionAll(low_of.select(F.col("m").alias("a"), "b")).distinct(), "links")
        drop_staged(current, low, large, low_of)
        current = small
    found = current.select(F.col("b").alias("node"), F.col("a").alias("component"))
    found._staged_path = current._staged_path  # so that a scope can keep it
    return found
