"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trenchbook.llm.store import Store


def _min_of(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the smallest v that u has."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = _min_of(both).withColumn("m", F.least("m", "u"))
    return near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    near = _min_of(edges)
    up = near.select(F.col("u"), F.col("m").alias("v"))
    across = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return up.unionByName(across).distinct()


def components(links: DataFrame, store: Store) -> DataFrame:
    """Rows (node, root) for every node of a link (a, b): root is the smallest node it reaches.

    Each round is two aggregations and two joins; the table is written after it. The links become
    stars in a number of rounds that grows with the logarithm of the longest path.
    """
    a, b = F.col("a"), F.col("b")
    edges = store.keep(
        links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    mark = F.struct(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    seen = edges.agg(mark).first()
    while seen[0][0]:
        edges = store.keep(_small_star(_large_star(edges)))
        now = edges.agg(mark).first()
        if now == seen:
            break
        seen = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
