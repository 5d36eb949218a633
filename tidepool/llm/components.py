"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import storage


def _starred(edges: DataFrame) -> DataFrame:
    """Edges (u, m): every neighbour points at the least one; by aggregates and joins, so a hub is split like any key."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.where(F.col("u") != F.col("v")).distinct()
    # now every u has larger id than v
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("x"), "m"), F.struct(F.col("u").alias("x"), "m"))).alias("e"))
    return small.select(F.col("e.x").alias("u"), F.col("e.m").alias("v")).where(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every linked node; ``root`` is the least node of its component."""
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col("u") != F.col("v")).distinct()
    edges, before = storage.written(edges, "links"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        edges, before = storage.written(_starred(edges), "stars"), state
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
