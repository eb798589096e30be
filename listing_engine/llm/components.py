"""Connected components by alternating large and small stars.

Each round rewires every node to the smallest node of its neighbourhood: first
the larger neighbours, then the smaller ones.  What is left when nothing
changes is one star per component.  A round is two aggregations and two joins
on the edges; the edges are cut from their lineage by a checkpoint after each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """`edges` with the `m` of their `u`.

    The join has a second key, so that it doesn't run in the partitions of the
    aggregation but in a shuffle of its own, which adaptive execution can
    split where a node has very many edges."""
    hashed = F.xxhash64("u").alias("h")
    return edges.select("u", "v", hashed).join(least.select("u", "m", hashed), ["u", "h"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of `edges` (a, b) that is not its component's smallest.

    Repeated edges and loops don't matter; no edges give no rows.
    """
    stars = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        now = stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before or not now[0]:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before = now
        both = stars.union(stars.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _with_least(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _with_least(large, least).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = cut_lineage(small.union(least.select("u", "m")).distinct())
