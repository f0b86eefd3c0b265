"""Connected components of a table of links, as joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendmill.session import discard, stage


def _lowest(links: DataFrame, label: str) -> DataFrame:
    """Each node's smallest neighbour or itself, stored, so that the join with it can split hot nodes."""
    return stage(links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), label)


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Links from each node's larger (or smaller) neighbours to the smallest node around it.

    Both kinds keep what is connected; taken in turns they end in stars around the smallest nodes.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _lowest(both if larger else links, "star")
    if larger:
        out = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        moved = links.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        out = moved.unionByName(low.select("a", F.col("low").alias("b")))
    return out.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node that ``links`` (a, b: two comparable columns) lead to.

    Only nodes of a link appear. Links to null or to the node itself are left out. Rounds are stored
    in the shared folder; only two numbers per round reach the driver.
    """
    links = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links, before = stage(links.distinct(), "links"), None
    while True:
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before, last = now, links
        large = stage(_star(links, larger=True), "large")
        links = stage(_star(large, larger=False), "small")
        discard(last), discard(large)
