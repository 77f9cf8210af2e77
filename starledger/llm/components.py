"""Connected components of a link table by alternating stars, on any number of executors.

Each round points the larger neighbours of every node at the smallest node around it, then
the smaller ones and the node itself. Rounds are stored, so a lost executor costs part of one;
a hub costs a row per task in the minimum, and its join is split by Spark at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starledger.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node that it is connected with, for linked nodes.

    Links may be repeated and in either direction; a link of a node with itself, or with a
    null, says nothing. Nodes without a link to another are left out.
    """
    ordered = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    ordered = ordered.where(f"{a} is not null and {b} is not null and u != v")
    edges, after = _stored(ordered.distinct())
    while True:
        (edges, after), before = _stored(_small_star(_large_star(edges))), after
        if after == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, stored, with their number and a sum that changes with them."""
    kept = stored(edges, "links")
    row = kept.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return kept, tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = both.where("v > u").join(least, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    smaller = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return smaller.union(least.select("u", F.col("m").alias("v"))).distinct()
