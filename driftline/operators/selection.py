"""Exact percentiles of long groups by counting, without a buffer of a group's values.

Two counting passes narrow the range of each wanted rank: all values are counted in BINS
equal bins of the table's range, then those of a wanted bin in BINS bins of its own. The
third pass counts the different values of the wanted bins and picks the ranks. Counts are
added up before they are shuffled, so a group costs BINS counters in a task, however many
rows it has and however often a value repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driftline.session import written

BINS = 4096
#: Values of a group that an aggregate may hold at once; longer groups are counted.
HELD = 1 << 20
#: Wanted bins up to this number meet the rows by broadcast.
BROADCAST_BINS = 100_000


def long_groups(rows: DataFrame, keys: list[str], counts: Column, held: int = HELD) -> DataFrame | None:
    """Keys of the groups with more than ``held`` rows for which ``counts`` holds; None if there are none."""
    if rows.count() <= held:  # of written rows the files' footers tell
        return None
    sizes = written(rows.groupBy(*keys).agg(F.count_if(counts).alias("n")).filter(F.col("n") > held).select(*keys), "long")
    return None if sizes.isEmpty() else sizes


def _ranked(counts: DataFrame, by: list[str], bin_: str, wanted: DataFrame) -> DataFrame:
    """The wanted ranks (i, rank within ``by``) with the bin that holds each and the rank within it."""
    along = W.partitionBy(*by).orderBy(bin_)
    cumulated = counts.withColumn("upto", F.sum("n").over(along))
    hit = cumulated.join(wanted, by).filter((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
    return hit.select(*by, bin_, "i", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"))


def _only(rows: DataFrame, wanted: DataFrame, by: list[str]) -> DataFrame:
    bins = wanted.select(*by).distinct()
    return rows.join(F.broadcast(bins) if wanted.count() <= BROADCAST_BINS else bins, by, "left_semi")


def percentiles(rows: DataFrame, keys: list[str], value: str, fractions: list[float]) -> DataFrame:
    """keys and ``points``: the linearly interpolated percentiles of each group's values, as ``percentile`` gives them.

    Nulls are left out and a group without values has no row. Null keys are equal.
    """
    rows = rows.filter(F.col(value).isNotNull()).select(F.struct(*keys).alias("g"), F.col(value).cast("double").alias("v"))
    lo, hi = rows.agg(F.min("v"), F.max("v")).first()
    if lo is None:
        return rows.select("g.*", F.array(F.col("v")).alias("points"))
    # halved, so that the width of the range is a number; monotone, whatever is rounded
    x = F.coalesce(F.try_divide(F.col("v") / 2 - lo / 2, F.lit(hi / 2 - lo / 2)), F.lit(0.0)) * BINS
    first = F.least(F.floor(x), F.lit(BINS - 1)).cast("int")
    second = F.least(F.floor((x - F.col("a")) * BINS), F.lit(BINS - 1)).cast("int")
    rows = rows.withColumn("a", first).withColumn("b", second)

    counts = written(rows.groupBy("g", "a").agg(F.count("*").alias("n")), "bins")
    place = [(F.col("n") - 1) * p for p in fractions]
    ranks = F.array(*(F.struct(F.lit(2 * i + up).alias("i"), f(x).cast("long").alias("rank")) for i, x in enumerate(place) for up, f in ((0, F.floor), (1, F.ceil))))
    totals = counts.groupBy("g").agg(F.sum("n").alias("n"))
    wanted = written(_ranked(counts, ["g"], "a", totals.select("g", F.inline(ranks))), "wanted")
    finer = _only(rows, wanted, ["g", "a"]).groupBy("g", "a", "b").agg(F.count("*").alias("n"))
    wanted = written(_ranked(finer, ["g", "a"], "b", wanted), "wanted")
    values = _only(rows, wanted, ["g", "a", "b"]).groupBy("g", "a", "b", "v").agg(F.count("*").alias("n"))
    picked = _ranked(values, ["g", "a", "b"], "v", wanted)

    at = lambda i: F.max(F.when(F.col("i") == i, F.col("v")))
    points = picked.groupBy("g").agg(*(at(i).alias(f"v{i}") for i in range(2 * len(fractions)))).join(totals, "g")

    def between(i: int, p: float) -> Column:
        low, high, x = F.col(f"v{2 * i}"), F.col(f"v{2 * i + 1}"), (F.col("n") - 1) * p
        return F.when(low == high, low).otherwise((F.ceil(x) - x) * low + (x - F.floor(x)) * high)

    return points.select("g.*", F.array(*(between(i, p) for i, p in enumerate(fractions))).alias("points"))
