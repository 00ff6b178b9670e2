"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, label) with the smallest node of each component as label.

    ``edges`` has long columns u and v. Nodes without an edge do not occur in the
    result. Each step groups with map-side minima and joins them back, so that a
    node with very many neighbours is split by the skew join; every step is
    written to the shared folder. The number of steps grows with the logarithm of
    the longest path. An empty table gives an empty one.
    """
    e = stored(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "cc",
    )
    mark = _mark(e)
    while mark[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        # every node keeps its link to its own minimum
        large = large.union(least.filter("u <> m").select("u", F.col("m").alias("v")))
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(down, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).union(down.select("u", F.col("m").alias("v")))
        last, e = e, stored(
            small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
            "cc",
        )
        discard(last)
        new = _mark(e)
        if new == mark:
            break
        mark = new
    leaves = e.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return leaves.union(leaves.select(F.col("label").alias("node"), "label")).distinct()
