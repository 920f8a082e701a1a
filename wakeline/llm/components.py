"""Connected components of a table of links, by alternating large-star and small-star steps.

Each step replaces every node's links by links to its smallest neighbour, so the number of links never grows, and a
chain halves with each pair of steps. Nodes with very many links are reduced by a map-side minimum and met again by
a join that Spark can split. The links are a written table after each step; none of it passes the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import BROADCAST_ROWS, staged


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _meet(links: DataFrame, least: DataFrame, few: bool) -> DataFrame:
    return links.join(F.broadcast(least) if few else least, "a")


def _large_star(links: DataFrame, few: bool) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    larger = _meet(both.where("b > a"), least, few)
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame, few: bool) -> DataFrame:
    """Links go from the larger node ``a`` to the smaller ``b``."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = _meet(links, least, few).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``links`` (a, b) but the roots: the least node that its links reach."""
    links = staged(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links"
    )
    before = _state(links)
    few = before[0] <= BROADCAST_ROWS // 2  # the number of links never grows, and each has two nodes
    while True:
        links = staged(_small_star(_large_star(links, few), few), "links")
        after = _state(links)
        if after == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after
