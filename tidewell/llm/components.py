"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import heavy_limit, spread_join, staged, unstage


def _star(links: DataFrame, both_ways: bool, limit: int) -> DataFrame:
    """Links of every node's neighbours (of those above it, if both_ways, else of those below it)
    to the smallest id among the node and its neighbours. At most one link for each of links, and
    one for each node if not both_ways; some may repeat. Minima are pre-aggregated; in the join
    back, a node with very many links is dealt to several tasks."""
    down, up = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")), links.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    least = (down.unionAll(up) if both_ways else down).groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    side = up if both_ways else down
    out = spread_join(side, least, ["u"], "v", side.groupBy("u").count(), limit).select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    if not both_ways:
        out = out.unionAll(least.select(F.col("u").alias("hi"), F.col("m").alias("lo")))
    return out.where("hi > lo")


def _unsettled(links: DataFrame) -> int:
    """How many nodes have two centres, or are a centre and have one: none, if every component is a star around its smallest node."""
    ends = links.select(F.col("hi").alias("u"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(links.select(F.col("lo").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or (up > 0 and down > 0)").agg(F.count("*")).first()[0]


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """node, root of every linked node that isn't itself the smallest of its component; a staged table.

    links: (hi, lo) with hi > lo, whatever the direction of the link; they may repeat; links with
    a null end don't count. Each round replaces the links by stars around smaller centres and is
    written as a table; a path of n nodes takes O(log n) rounds. Only counts and at most a few
    hundred heavy centres come to the driver. No links give no rows.
    """
    current = staged(links.where("hi > lo").select("hi", "lo").distinct(), name)
    while _unsettled(current):
        limit = heavy_limit(current.count())
        half = staged(_star(current, True, limit).distinct(), name)
        following = staged(_star(half, False, limit).distinct(), name)
        unstage(current, half)
        current = following
    out = current.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    out._staged_path = current._staged_path
    return out
