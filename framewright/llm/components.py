"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a grouped minimum and a join, so a vertex with many edges is never gathered; the edge
table is written after every round and its lineage ends there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``vertex, root`` for every vertex of the edges ``a, b`` (long): root is the least vertex
    reachable.  Loops and repeated edges are harmless; no edges give no rows."""
    plain = edges.where(F.col("a") != F.col("b"))
    now = stored(plain.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "edges")
    seen = None
    while True:
        # Large star: each vertex's larger neighbours are linked to the least of its neighbourhood.
        both = now.unionByName(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("m"))
        large = both.where(F.col("u") > F.col("v")).join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = large.where(F.col("v") != F.col("u")).distinct()
        # Small star: each vertex and its smaller neighbours are linked to the least of them.
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.explode(F.array(F.col("u"), F.col("v"))).alias("v"), F.col("m").alias("u"))
        now = stored(small.where(F.col("v") != F.col("u")).distinct(), "edges")
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("h")).first()
        if mark == seen:
            break
        seen = mark
    roots = now.select(F.col("v").alias("vertex"), F.col("u").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("vertex"), "root").distinct())
