"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lintlake.functions.scale import stage


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in the edges (a, b): the smallest id that links lead to.

    Alternates the large-star and small-star operations until the edges are stars. Every step is a minimum per id
    (combined before the shuffle) and an equality join of the edges with it; each round is written to the shared folder.
    Self-loops and nulls are ignored.
    """
    pairs = edges.dropna(subset=["a", "b"]).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = stage(pairs.filter("u != v").distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
        both = now.union(now.select("v", "u"))
        smallest = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stage(small.union(smallest.select("u", "m")).distinct(), "edges")
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
