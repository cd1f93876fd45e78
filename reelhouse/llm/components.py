"""Connected components by alternating stars, with every step a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import kept


def _stars_only(edges: DataFrame) -> bool:
    """Whether every node points at one that points nowhere: then each component is one star."""
    inner = edges.join(edges.select(F.col("u").alias("v")).distinct(), "v", "left_semi")
    return inner.isEmpty() and edges.groupBy("u").count().filter("count > 1").isEmpty()


def _star(pairs: DataFrame, small: bool) -> DataFrame:
    """`pairs` (u, v): join the neighbours v of u, and u itself, to the least of them. A large star sends on
    those above u, a small one is over neighbours below u only."""
    lowest = pairs.groupBy("u").agg(F.min("v").alias("_m"))
    least = F.least("_m", "u")
    sent = pairs.join(lowest.select("u", least.alias("m")), "u")
    if small:
        own = lowest.select(F.col("u").alias("v"), least.alias("m"))
        sent = sent.select("v", "m").unionByName(own)
    else:
        sent = sent.filter("v > u").select("v", "m")
    return sent.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """`node`, `label` (the least node of its component) for all nodes of the links `a`, `b`, except those
    that are their own label. Takes a number of rounds that grows with the logarithm of the size."""
    pairs = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
    edges = kept(pairs.distinct(), "links")
    while not _stars_only(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = kept(_star(both, small=False), "links")
        edges = kept(_star(large, small=True), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
