"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill.llm.shared import staged, unstage


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Link a node's neighbours on one side, and itself, to the least of them."""
    if larger:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = links  # u is the larger one
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("least"))
    around = both.filter("v > u") if larger else both.unionByName(links.select("u", F.col("u").alias("v")))
    moved = around.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.filter("u > v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component``, its smallest connected node, for every node with a link.

    Needs about as many rounds as the logarithm of the longest path; a node with very many links
    is the hot side of an ordinary join, whose partitions can be split. Links of a node to itself
    and null nodes are ignored.
    """
    x, y = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    now = staged(links.filter(F.col(a) != F.col(b)).select(x, y).distinct())
    state = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state or not seen[0]:
            break
        state = seen
        before, now = now, staged(_star(_star(now, larger=True), larger=False))
        unstage(before)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
