"""Reduction of windows of a series to statistics, coverage and day-based features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driftline.functions import calendar, naming
from driftline.functions.stats import null_safe_join
from driftline.operators import selection
from driftline.operators.slices import with_neighbours
from driftline.session import written


def statistics(v: Column, held: Column | None = None) -> list[Column]:
    """Mean, extremes, linear 5 and 95 % points (of one buffer, of ``held`` if given) and sample variance (null for one value)."""
    points = F.percentile(v if held is None else held, [0.05, 0.95])
    return [
        F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"),
        points[0].alias("p05"), points[1].alias("p95"), F.var_samp(v).alias("variance"),
    ]


def expected(start: Column, end: Column, cadence: Column, closed: bool) -> Column:
    n = calendar.seconds(end, start) / cadence
    return n + 1 if closed else n


def coverage(n: Column, exp: Column) -> Column:
    return F.coalesce(F.least(F.try_divide(n, exp), F.lit(1.0)), F.lit(0.0))


def _intervals(kept: DataFrame, keys: list[str]) -> DataFrame:
    """``kept`` with dt, the seconds since the row before, found without a task that holds a group."""
    near = with_neighbours(kept, keys, ["timestamp"], [], "day")
    return near.withColumn("dt", calendar.seconds(F.col("timestamp"), F.col("__before")["timestamp"]))


def cadence_of(kept: DataFrame, keys: list[str], held: int = selection.HELD) -> DataFrame:
    """Median interval of each key's rows in seconds; null below two rows or if not positive.

    Groups of up to ``held`` rows hold their intervals together, those of longer ones are counted.
    """
    long = selection.long_groups(kept, keys, F.lit(True), held)
    short = kept if long is None else null_safe_join(kept, long, keys, "left_anti")
    dt = calendar.seconds(F.col("timestamp"), F.lag("timestamp").over(W.partitionBy(*keys).orderBy("timestamp")))
    m = F.median("dt")
    out = short.withColumn("dt", dt).groupBy(*keys).agg(F.when(m > 0, m).alias("cadence_s"))
    if long is None:
        return out
    points = selection.percentiles(_intervals(null_safe_join(kept, long, keys, "left_semi"), keys), keys, "dt", [0.5])
    return out.unionByName(points.select(*keys, F.when(F.col("points")[0] > 0, F.col("points")[0]).alias("cadence_s")))


def spells(days: DataFrame, keys: list[str], over: Column, start: str, end: str) -> DataFrame:
    """Longest run of consecutive days for which ``over`` holds, and whether a gap cut one of the longest short.

    ``days`` has one row for each observed day. A day nobody observed ends a run and
    is not bridged; it marks the run if it lies inside the window from ``start`` to
    ``end``, so a run that the window's edge ends is not marked.
    """
    w = W.partitionBy(*keys).orderBy("day")
    d = days.withColumn("seen_before", F.coalesce(F.lag("day").over(w) == F.date_sub("day", 1), F.lit(False)))
    d = d.withColumn("seen_after", F.coalesce(F.lead("day").over(w) == F.date_add("day", 1), F.lit(False)))
    d = d.filter(over).withColumn("island", F.date_sub("day", F.row_number().over(w)))
    at = lambda c: c.cast("timestamp_ntz")
    runs = d.groupBy(*keys, "island").agg(
        F.count("*").alias("length"),
        F.min("day").alias("from_day"), F.max("day").alias("to_day"),
        F.min_by("seen_before", "day").alias("sb"), F.max_by("seen_after", "day").alias("sa"),
        F.first(start).alias("w0"), F.first(end).alias("w1"),
    )
    cut = (~F.col("sb") & (at(F.date_sub("from_day", 1)) >= F.col("w0"))) | (~F.col("sa") & (at(F.date_add("to_day", 1)) < F.col("w1")))
    ranked = runs.withColumn("cut", cut).withColumn("longest", F.max("length").over(W.partitionBy(*keys)))
    return ranked.filter("length = longest").groupBy(*keys).agg(
        F.first("longest").cast("double").alias("spell"), F.bool_or("cut").alias("interrupted")
    )


def reduce_windows(
    rows: DataFrame, keys: list[str], features: dict, floor: float, closed: bool = False,
    day_based: bool = True, cadence: str | None = None, most: int = 2, held: int = selection.HELD,
) -> DataFrame:
    """One row for each group of ``keys``, also where no row is kept.

    ``rows`` has the keys (parameter among them), timestamp, value, qc_flag, keep (may it
    count), w_start and w_end. With ``cadence`` that column is the cadence, measured
    elsewhere; without, it is measured in the group. ``most`` is the largest flag that
    keep let count, which each row records as qc_max_flag. clamped marks a group with
    more rows than its cadence lets expect. The columns named here are written
    once, as several parts read them; statistics, counts and cadence then
    come from one shuffle by the keys, and the days are reduced once for all thresholds.
    Observed days are counted where the day changes along the sorted rows, without a
    distinct; with ``cadence`` a group lies within one day. Groups of up to ``held`` kept
    rows hold their values together for the exact percentiles and the cadence; those of
    longer ones are found by counting (:mod:`driftline.operators.selection`), the same numbers.
    """
    columns = naming.feature_columns(features)
    rows = written(rows.select(*dict.fromkeys([*keys, "parameter", "timestamp", "value", "keep", "w_start", "w_end", *([cadence] if cadence else [])])), "windows")
    long = selection.long_groups(rows, keys, F.col("keep"), held)
    is_long = F.lit(False)
    if long is not None:
        rows = null_safe_join(rows, long.withColumn("__long", F.lit(True)), keys)
        is_long = F.coalesce("__long", F.lit(False))
    kept_value = F.when(F.col("keep"), F.col("value"))
    last = F.lag("timestamp").over(W.partitionBy(*keys, "keep").orderBy("timestamp"))
    day_starts = F.col("keep") & (F.col("last").isNull() | (F.to_date("timestamp") != F.to_date("last")))
    if cadence:
        measured, n_days = rows, F.max(F.col("keep").cast("long"))
    else:
        measured = rows.repartition(*keys).withColumn("last", last)
        measured = measured.withColumn("dt", F.when(F.col("keep") & ~is_long, calendar.seconds(F.col("timestamp"), F.col("last"))))
        n_days = F.count_if(day_starts)
    med = F.median("dt") if not cadence else F.first(cadence)
    bands = [(p, a, b) for p, t in features.items() for a, b in (t or {}).get("time_in_band", ())]
    main = measured.groupBy(*keys).agg(
        F.count(kept_value).alias("n_obs"),
        F.coalesce(n_days, F.lit(0).cast("long")).alias("n_days_observed"),
        F.when(med > 0, med).alias("cadence_s"),
        F.first("w_start").alias("w_start"), F.first("w_end").alias("w_end"),
        F.lit(most).alias("qc_max_flag"),
        *statistics(kept_value, F.when(~is_long, kept_value)),
        *(F.avg(F.when(F.col("keep") & (F.col("parameter") == p), F.col("value").between(a, b).cast("double"))).alias(f"frac_in_band_{naming.band_label(a, b)}") for p, a, b in bands),
    )
    if long is not None:
        counted = rows.filter(F.col("keep") & is_long)
        points = selection.percentiles(counted, keys, "value", [0.05, 0.95])
        main = null_safe_join(main, points, keys)
        main = main.withColumns({"p05": F.coalesce("p05", F.col("points")[0]), "p95": F.coalesce("p95", F.col("points")[1])}).drop("points")
        if not cadence:
            main = null_safe_join(main, selection.percentiles(_intervals(counted, keys), keys, "dt", [0.5]), keys)
            main = main.withColumn("cadence_s", F.coalesce("cadence_s", F.when(F.col("points")[0] > 0, F.col("points")[0]))).drop("points")
    exp = expected(F.col("w_start"), F.col("w_end"), F.col("cadence_s"), closed)
    out = (
        main.withColumn("expected_obs", exp)
        .withColumn("pct_coverage", coverage(F.col("n_obs"), F.col("expected_obs")))
        .withColumn("clamped", F.coalesce(F.col("n_obs") > F.col("expected_obs"), F.lit(False)))
        .withColumn("usable", (F.col("n_obs") >= 2) & (F.col("pct_coverage") >= floor))
    )
    with_days = [(p, t) for p, t in features.items() if any((t or {}).get(k) for k in naming.DAY_BASED)]
    if day_based and with_days:
        wanted = rows.filter("keep").filter(F.col("parameter").isin(*(p for p, _ in with_days)))
        days = wanted.groupBy(*keys, F.to_date("timestamp").alias("day")).agg(
            F.max("value").alias("dmax"), F.min("value").alias("dmin"), F.avg("value").alias("dmean"),
            F.first("w_start").alias("w_start"), F.first("w_end").alias("w_end"),
        )
        aggs = []
        for p, t in with_days:
            mine = F.col("parameter") == p
            lab = naming.threshold_label
            aggs += [F.sum(F.when(mine, (F.col("dmax") > x).cast("double"))).alias(f"days_above_{lab(x)}") for x in t.get("days_above", ())]
            aggs += [F.sum(F.when(mine, (F.col("dmin") < x).cast("double"))).alias(f"days_below_{lab(x)}") for x in t.get("days_below", ())]
            aggs += [F.sum(F.when(mine, F.greatest(F.col("dmean") - x, F.lit(0.0)))).alias(f"degree_days_above_{lab(x)}") for x in t.get("degree_days_above", ())]
        if aggs:
            out = null_safe_join(out, days.groupBy(*keys).agg(*aggs), keys)
        for p, t in with_days:
            for x in t.get("max_spell_above", ()):
                name = f"max_spell_above_{naming.threshold_label(x)}"
                runs = spells(days.filter(F.col("parameter") == p), keys, F.col("dmax") > x, "w_start", "w_end")
                out = null_safe_join(out, runs, keys)
                has = (F.col("parameter") == p) & (F.col("n_obs") > 0)
                out = out.withColumn(f"{name}_days", F.when(has, F.coalesce("spell", F.lit(0.0)))).withColumn(
                    f"{name}_gap_interrupted", F.when(has, F.coalesce("interrupted", F.lit(False)))
                ).drop("spell", "interrupted")
    for name, kind in columns if day_based else naming.without_day_based(columns):
        if name not in out.columns:
            out = out.withColumn(name, F.lit(None).cast(kind))
    return out
