"""Connected components of a graph, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.plans.staging import stage


def _checksum(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("hi", "lo").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashed)).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node that has a link, ``root`` the smallest node of its component.

    Each round hangs all neighbours of a node below the smallest of them, so that the depth
    halves: rounds grow with the logarithm of the longest path. The edges of a round are
    written down, which cuts the lineage, and the number of edges never grows. Smallest
    neighbours are written as well: both sides of the join that hands them out are then plain
    exchanges, and adaptive execution can split a node that has very many neighbours.

    NULL ends and links of a node with itself are left out; no links give an empty table.
    """
    pairs = links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    edges = stage(pairs.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("hi") != F.col("lo"))).distinct(), "component-edges")
    before = _checksum(edges)
    while before[0]:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = stage(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "component-least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = stage(large, "component-large")
        least = stage(large.groupBy("hi").agg(F.min("lo").alias("m")), "component-least")
        joined = large.join(least, "hi")
        small = joined.select("hi", F.col("m").alias("lo")).unionByName(
            joined.filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        )
        edges = stage(small.distinct(), "component-edges")
        after = _checksum(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return stars.unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root"))).distinct()
