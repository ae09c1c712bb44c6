"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import land


def _min_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("low"))


def _state(edges: DataFrame) -> tuple:
    got = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(got)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node it reaches.

    Every round writes its edges to the shared folder. Rounds grow with the logarithm of the
    longest path; the driver sees one count and one checksum a round.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    now = land(pairs, label)
    state = _state(now)
    while state[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: larger neighbours of u point to the smallest node around u
        low = _min_neighbour(both).select("u", F.least("u", "low").alias("low"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        # small star: u and its smaller neighbours point to the smallest of them
        small_low = _min_neighbour(large)
        small = large.join(small_low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).union(small_low.select("u", "low"))
        now = land(small.filter("u != v").distinct(), label)
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
