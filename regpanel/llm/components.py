"""Connected components over a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import joined_to_keys, written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One contraction: neighbours of a node are linked to the least of them.

    Large: every larger neighbour; small: the node and all its smaller ones.
    """
    if large:
        facing = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        facing = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = written(facing.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("_m"), F.count(F.lit(1)).alias("_rows")), "least-neighbours")
    moved = joined_to_keys(facing, least, "a")          # the centre of a star may face most nodes
    if large:
        out = moved.where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("_m").alias("b")).unionByName(least.select("a", F.col("_m").alias("b")))
    out = out.where("a <> b")
    return out if large else out.distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long) to one row per linked node: node, root (the least node of its component).

    Every contraction is written to the shared folder, so the plan stays short;
    the number of rounds grows with the logarithm of a component's diameter.
    """
    links = written(links.where("a <> b").distinct(), "links")
    before = None
    while True:
        state = links.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
        if tuple(state) == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = tuple(state)
        links = written(_star(_star(links, large=True), large=False), "links")
