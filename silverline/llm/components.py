"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import materialise


def _state(edges: DataFrame) -> tuple:
    """Tells whether two sets of edges are the same."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """Label nodes by the smallest node that they are linked to, directly or not: (u, root), a row per node of an edge.

    `edges` has longs `u` and `v`; loops and repeats do no harm. Alternates two steps until nothing changes:
    every node links its larger neighbours, then itself and its smaller neighbours, to the smallest node it
    knows. Each step is a minimum by node, summed before the shuffle, and a join that Spark splits where a node is
    hot; the number of edges never grows, and rounds grow with the logarithm of the size. Every round is written,
    so a lost executor costs the reading of a file.
    """
    links = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    links = materialise(links.distinct(), "links")
    before = None
    while (now := _state(links)) != before:
        before = now
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(large.distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = materialise(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
    roots = links.select(F.col("v").alias("u")).distinct()
    return links.select("u", F.col("v").alias("root")).union(roots.select("u", F.col("u").alias("root")))
