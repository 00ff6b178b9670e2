"""Neighbours along a series without a task that holds the series.

A series is cut into slices of time. Within a slice the neighbours come from a window; the
first and the last row of a slice get theirs from a halo: the slice's edge rows, one row
for each slice, are ordered along the series and handed to the slices beside. What meets
in one task is a slice of rows, or the edges of a series' slices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Span of a slice, one of SPANS.
SLICE = "month"
SPANS = ("year", "quarter", "month", "week", "day", "hour", "minute", "second")


def with_neighbours(rows: DataFrame, keys: list[str], order: list[str], carried: list[str], width: str = SLICE) -> DataFrame:
    """``rows`` with __before and __after (structs of order and carried columns of the neighbours) and __n.

    ``order`` begins with a timestamp, by which the slices are cut; rows that agree in all
    of it are ordered by ``carried``. __before and __after are null at the ends of a series,
    which are no ends of a slice; __n counts the rows of the series. Null keys are equal,
    rows without a time come first.
    The edges are found by a second read of these columns, added up before they are shuffled.
    """
    if width not in SPANS:
        raise ValueError(f"a slice spans one of {', '.join(SPANS)}")
    key = F.struct(*keys).alias("__series")
    place = F.coalesce(F.date_trunc(width, order[0]), F.lit("0001-01-01").cast("timestamp_ntz")).alias("__slice")
    edge = F.struct(*order, *(c for c in carried if c not in order))
    w = W.partitionBy("__series", "__slice").orderBy(*order, *carried)
    inner = rows.select("*", key, place).withColumn("__edge", edge)
    inner = inner.withColumns({"__in_before": F.lag("__edge").over(w), "__in_after": F.lead("__edge").over(w)}).drop("__edge")
    edges = rows.select(key, place, edge.alias("e")).groupBy("__series", "__slice").agg(F.min("e").alias("first"), F.max("e").alias("last"), F.count("*").alias("n"))
    along = W.partitionBy("__series").orderBy("__slice")
    halo = edges.select(
        "__series", "__slice", F.lag("last").over(along).alias("__halo_before"), F.lead("first").over(along).alias("__halo_after"),
        F.sum("n").over(W.partitionBy("__series")).alias("__n"),
    )
    return inner.join(halo, ["__series", "__slice"]).select(
        *rows.columns, F.coalesce("__in_before", "__halo_before").alias("__before"), F.coalesce("__in_after", "__halo_after").alias("__after"), "__n"
    )
