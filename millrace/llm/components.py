"""Connected components of an edge table, with every intermediate table written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.session import stored


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: every node of an edge and the smallest node it can reach.

    Alternating large-star and small-star steps. Each step is a minimum per node, aggregated before its shuffle, and a
    join with the edges, whose hot nodes adaptive execution can split. Rounds grow with the logarithm of the longest
    path. Edges with a null end are left out; a loop makes its node a component of its own unless others reach it.
    """
    edges = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u IS NOT NULL AND v IS NOT NULL")
    nodes = stored(edges.select("u", "v").distinct(), "edges")
    current = nodes.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    before = None
    while True:
        both = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v")  # repeated edges go with the distinct below
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").union(
            least.select("u", F.col("m").alias("v")))
        current = stored(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "stars")
        now = _fingerprint(current)
        if now == before:
            break
        before = now
    everyone = nodes.select(F.col("u").alias("node")).union(nodes.select(F.col("v").alias("node"))).distinct()
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return everyone.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
