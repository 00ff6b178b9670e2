"""Quarterly, deployment, daily and hourly features, climatology and anomalies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driftline.functions import calendar, naming
from driftline.functions.stats import null_safe_join
from driftline.operators.quality import SERIES
from driftline.operators.watch import Watch, counted, counted_once
from driftline.operators.windowed import cadence_of, reduce_windows
from driftline.session import written

QUARTER = [*SERIES, "year", "quarter"]


def build_quarterly(obs: DataFrame, features: dict, floor: float, now: str, most: int = 2, watch: Watch | None = None) -> DataFrame:
    """One row for each series and UTC quarter that has any row, however its quality.

    Parameters without a declared feature set are left out (see :func:`unbuilt`). ``watch`` counts
    their rows, quarters with more rows than their cadence lets expect, and quarters without a kept row.
    """
    start = calendar.quarter_start(F.col("timestamp"))
    obs = counted(watch, obs, "quarterly_env", rows_of_unbuilt_parameters=~F.col("parameter").isin(*features))
    rows = (
        obs.filter(F.col("parameter").isin(*features))
        .withColumn("year", F.year("timestamp")).withColumn("quarter", F.quarter("timestamp").cast("tinyint"))
        .withColumn("keep", (F.col("qc_flag") <= most) & F.col("value").isNotNull())
        .withColumn("w_start", start).withColumn("w_end", calendar.quarter_end(start))
    )
    out = reduce_windows(rows, QUARTER, features, floor, most=most)
    out = counted_once(watch, out, "quarterly_env", quarters_clamped=F.col("clamped"), quarters_without_rows=F.col("n_obs") == 0)
    sets = F.lit(None).cast("string")
    for p, t in features.items():
        sets = F.when(F.col("parameter") == p, F.lit("thresholds" if t else "statistics")).otherwise(sets)
    return out.withColumn("quarter_complete", calendar.is_complete(F.col("w_end"), now)).withColumn("feature_set", sets).drop("w_start", "w_end")


def unbuilt(obs: DataFrame, features: dict) -> DataFrame:
    """Parameters that occur and have no feature set, with their rows."""
    return obs.filter(~F.col("parameter").isin(*features)).groupBy("parameter").agg(F.count("*").alias("n_rows"))


def baseline_bounds(site: Column, baseline: dict) -> tuple[Column, Column]:
    """First and last baseline year of a site: its declared override, else the common window."""
    lo, hi = F.lit(baseline["start_year"]), F.lit(baseline["end_year"])
    for name, o in baseline.get("overrides", {}).items():
        lo = F.when(site == name, F.lit(o["start_year"])).otherwise(lo)
        hi = F.when(site == name, F.lit(o["end_year"])).otherwise(hi)
    return lo, hi


def climatology(quarterly: DataFrame, measured: list[str], series: list[str], baseline: dict, site: str) -> DataFrame:
    """Series x quarter x feature: n_years, baseline_mean, baseline_std over usable, complete quarters of the window.

    The features are unpivoted once; years are counted where the feature has a value.
    """
    lo, hi = baseline_bounds(F.col(site), baseline)
    rows = quarterly.withColumn("baseline_start_year", lo).withColumn("baseline_end_year", hi).filter(
        "usable and quarter_complete and year between baseline_start_year and baseline_end_year"
    )
    keys = [*series, "quarter", "baseline_start_year", "baseline_end_year"]
    long = rows.select(*keys, "year", *(F.col(m).cast("double").alias(m) for m in measured)).unpivot([*keys, "year"], measured, "feature", "x")
    return long.filter("x is not null").groupBy(*keys, "feature").agg(
        F.count_distinct("year").alias("n_years"), F.avg("x").alias("baseline_mean"), F.stddev_samp("x").alias("baseline_std")
    )


def contributing_years(quarterly: DataFrame, series: list[str], baseline: dict, site: str) -> DataFrame:
    """Distinct years that feed the baseline of each series and quarter."""
    lo, hi = baseline_bounds(F.col(site), baseline)
    return quarterly.filter(F.col("usable") & F.col("quarter_complete") & F.col("year").between(lo, hi)).groupBy(*series, "quarter").agg(
        F.count_distinct("year").alias("baseline_years")
    )


def with_anomalies(quarterly: DataFrame, clim: DataFrame, measured: list[str], series: list[str], baseline: dict, site: str) -> DataFrame:
    """``quarterly`` with baseline_years and a ``_anom`` for each feature; null below min_years.

    The climatology is pivoted over its known features, so each quarter is joined once.
    """
    enough = F.col("n_years") >= baseline["min_years"]
    wide = clim.groupBy(*series, "quarter").agg(
        *(F.max(F.when((F.col("feature") == m) & enough, F.col("baseline_mean"))).alias(f"__b_{m}") for m in measured)
    )
    keys = [*series, "quarter"]
    out = null_safe_join(quarterly, wide, keys)
    out = null_safe_join(out, contributing_years(quarterly, series, baseline, site), keys)
    for m in measured:
        out = out.withColumn(f"{m}_anom", F.col(m).cast("double") - F.col(f"__b_{m}"))
    return out.withColumn("baseline_years", F.coalesce("baseline_years", F.lit(0))).drop(*(f"__b_{m}" for m in measured))


def needless_overrides(quarterly: DataFrame, baseline: dict, site: str = "site_id") -> DataFrame:
    """Overridden sites that the common window would serve, with the most years any quarter has there."""
    common = quarterly.filter(F.col("usable") & F.col("quarter_complete") & F.col("year").between(baseline["start_year"], baseline["end_year"]))
    years = common.filter(F.col(site).isin(*baseline.get("overrides", {}))).groupBy(*SERIES, "quarter").agg(F.count_distinct("year").alias("n"))
    return years.groupBy(site).agg(F.max("n").alias("most_years")).filter(F.col("most_years") >= baseline["min_years"])


# --- the response: canopy area by polygon and quarter --------------------------------------


def build_canopy(landed: DataFrame, floor: float, now: str, baseline: dict) -> tuple[DataFrame, DataFrame]:
    """(quarterly canopy with anomalies, its climatology) from landed quarters.

    ``landed`` has polygon_id, year, quarter, area_m2, n_cells_canopy, n_cells_observed
    and n_cells. A quarter that no cell observed has no area, which is not zero.
    """
    start = F.make_date("year", F.col("quarter") * 3 - 2, F.lit(1)).cast("timestamp_ntz")
    seen = F.col("n_cells_observed") > 0
    q = (
        landed.withColumn("area_m2", F.when(seen, F.col("area_m2"))).withColumn("n_cells_canopy", F.when(seen, F.col("n_cells_canopy")))
        .withColumn("pct_coverage", F.coalesce(F.try_divide("n_cells_observed", "n_cells"), F.lit(0.0)))
        .withColumn("usable", seen & (F.col("pct_coverage") >= floor))
        .withColumn("quarter_complete", calendar.is_complete(calendar.quarter_end(start), now))
    )
    clim = climatology(q, ["area_m2"], ["polygon_id"], baseline, "polygon_id")
    return with_anomalies(q, clim, ["area_m2"], ["polygon_id"], baseline, "polygon_id"), clim


def quarterly_report(quarterly: DataFrame) -> DataFrame:
    """Quarters, usable ones, rows, first and last quarter of each built series."""
    label = calendar.quarter_label(F.col("year"), F.col("quarter"))
    return quarterly.groupBy(*SERIES, "feature_set").agg(
        F.sum("n_obs").alias("n_rows"), F.count("*").alias("n_quarters"), F.count_if("usable").alias("n_usable"),
        F.min(label).alias("first_quarter"), F.max(label).alias("last_quarter"),
    )


def union_builds(builds: list[DataFrame]) -> DataFrame:
    """The builds of several sources as one table; empty ones are ignored while another is not. Each is built once."""
    builds = [written(b, "build") for b in builds]
    full = [b for b in builds if not b.isEmpty()] or builds[:1]
    out = full[0]
    for b in full[1:]:
        out = out.unionByName(b)
    return out


def of_series(obs: DataFrame, deployments: DataFrame) -> DataFrame:
    """The observations of whole series that some deployment is on, so that tests run over those only."""
    d = deployments.select("site_id", "parameter", "depth_m").distinct()
    return null_safe_join(obs, d, ["site_id", "parameter", "depth_m"], "left_semi")


def deployment_attrition(deployment: DataFrame) -> DataFrame:
    """Deployments with rows, of them complete ones, and usable ones."""
    return deployment.agg(F.count("*").alias("n_with_rows"), F.count_if("deployment_complete").alias("n_complete"), F.count_if("usable").alias("n_usable"))


def canopy_report(canopy: DataFrame) -> DataFrame:
    """Rows, usable, observed, blind and thin quarters, first and last quarter of each polygon."""
    label = calendar.quarter_label(F.col("year"), F.col("quarter"))
    blind = F.col("n_cells_observed") == 0
    return canopy.groupBy("polygon_id").agg(
        F.count("*").alias("n_quarters"), F.count_if("usable").alias("n_usable"), F.count_if(~blind).alias("n_observed"),
        F.count_if(blind).alias("n_blind"), F.count_if(~blind & ~F.col("usable")).alias("n_thin"),
        F.min(label).alias("first_quarter"), F.max(label).alias("last_quarter"),
    )


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with how often: what a build refuses."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


# --- deployments -----------------------------------------------------------------------------

DEPLOYMENT = ["site_id", "serial", "deployment_number", "parameter", "depth_m"]


def deployment_rows(obs: DataFrame, deployments: DataFrame, most: int = 2) -> DataFrame:
    """Observations inside a deployment's closed window, on equal site, parameter and depth.

    A window is laid out over the months it touches, and an observation meets the windows of
    its own month, so one at a site of many deployments is not tried against all of them;
    deployments are a dimension and Spark broadcasts it while it is small.
    """
    month = lambda c: F.date_trunc("month", c).cast("timestamp_ntz")
    d = deployments.filter("w_start <= w_end").select(
        F.col("site_id").alias("__s"), F.col("parameter").alias("__p"), F.col("depth_m").alias("__d"), "serial", "deployment_number", "w_start", "w_end",
        F.explode(F.sequence(month("w_start"), month("w_end"), F.expr("interval 1 month"))).alias("__m"),
    )
    on = (
        (F.col("site_id") == F.col("__s")) & (F.col("parameter") == F.col("__p")) & F.col("depth_m").eqNullSafe(F.col("__d")) & (month("timestamp") == F.col("__m"))
        & F.col("timestamp").between(F.col("w_start"), F.col("w_end"))
    )
    keep = (F.col("qc_flag") <= most) & F.col("value").isNotNull()
    return obs.join(d, on).drop("__s", "__p", "__d", "__m").withColumn("keep", keep)


def build_deployment(obs: DataFrame, deployments: DataFrame, features: dict, floor: float, now: str, most: int = 2, watch: Watch | None = None) -> DataFrame:
    """Features over each deployment's own closed window; a deployment without a kept row has none.

    ``watch`` counts clamped deployments and those whose rows are none of them kept;
    :func:`empty_deployments` names all that are not built.
    """
    out = reduce_windows(deployment_rows(obs, deployments, most), DEPLOYMENT, features, floor, closed=True, most=most)
    out = counted_once(watch, out, "deployment", deployments_clamped=F.col("clamped"), deployments_without_kept_rows=F.col("n_obs") == 0)
    return out.filter("n_obs > 0").withColumn("deployment_complete", calendar.is_complete(F.col("w_end"), now))


def empty_deployments(deployments: DataFrame, built: DataFrame) -> DataFrame:
    """Declared deployments of which the build has no row: nothing was observed in them, or nothing kept."""
    return null_safe_join(deployments, built.select(*DEPLOYMENT), DEPLOYMENT, "left_anti")


def build_sub_windows(obs: DataFrame, deployments: DataFrame, features: dict, floor: float, grain: str, most: int = 2) -> DataFrame:
    """Features of each observed UTC day or hour of a deployment, clipped to its window.

    The cadence is measured once over the deployment. Spans are half-open and only
    the last one, which ends with the closed window, expects one sample more. Day-based
    features are left out.
    """
    kept = deployment_rows(obs, deployments, most).filter("keep").select(*DEPLOYMENT, "timestamp", "value", "keep", F.col("w_start").alias("d0"), F.col("w_end").alias("d1"))
    kept = written(kept, "clipped")
    kept = null_safe_join(kept, cadence_of(kept, DEPLOYMENT).withColumnRenamed("cadence_s", "cad"), DEPLOYMENT)
    begin = F.date_trunc(grain, "timestamp").cast("timestamp_ntz")
    end = begin + (F.expr("interval 1 day") if grain == "day" else F.expr("interval 1 hour"))
    spans = (
        kept.withColumn(grain, begin).withColumn("w_start", F.greatest(begin, "d0")).withColumn("w_end", F.least(end, "d1"))
        .withColumn("partial", (F.col("d0") > begin) | (F.col("d1") < end)).withColumn("is_last", F.col("d1") < end)
    )
    keys = [*DEPLOYMENT, grain, "partial", "is_last"]
    out = reduce_windows(spans, keys, features, floor, day_based=False, cadence="cad", most=most)
    more = F.col("expected_obs") + F.when(F.col("is_last"), 1).otherwise(0)
    share = F.coalesce(F.least(F.try_divide("n_obs", "expected_obs"), F.lit(1.0)), F.lit(0.0))
    return (
        out.withColumn("expected_obs", more).withColumn("pct_coverage", share)
        .withColumn("usable", (F.col("n_obs") >= 2) & (F.col("pct_coverage") >= floor))
        .withColumnRenamed("partial", f"partial_{grain}").drop("is_last")
    )


def _overlaps(windows: DataFrame, keys: list[str]) -> DataFrame:
    """``windows`` with __rank, their place by start within the keys, and __upto, the last place that starts within them.

    One sweep over the sorted starts and ends of the keys counts the starts that lie before
    each end, so what overlaps a window and starts no earlier is a run of places.
    """
    k = F.struct(*keys).alias("__key")
    rows = windows.filter("w_start <= w_end").withColumn("__key", k)
    rows = rows.withColumn("__rank", F.row_number().over(W.partitionBy("__key").orderBy("w_start", "w_end", "serial", "deployment_number")))
    ends = F.inline(F.array(F.struct(F.col("w_start").alias("at"), F.lit(0).alias("is_end")), F.struct(F.col("w_end").alias("at"), F.lit(1).alias("is_end"))))
    swept = rows.select("*", ends).withColumn("__upto", F.sum(1 - F.col("is_end")).over(W.partitionBy("__key").orderBy("at", "is_end").rangeBetween(W.unboundedPreceding, W.currentRow)))
    return swept.filter("is_end = 1").drop("at", "is_end")


def overlapping_deployments(deployments: DataFrame) -> DataFrame:
    """Pairs of deployments that would merge one series: same site, depth and parameter, overlapping windows.

    A window meets only those that overlap it (see :func:`_overlaps`), so the work grows
    with the windows and the pairs found, not with the square of a site's windows. Windows
    without a start or an end, or that end before they start, overlap none.
    """
    named = _overlaps(deployments, ["site_id", "parameter", "depth_m"])
    side = lambda s: named.select("__key", F.struct(*deployments.columns).alias(f"__{s}"), F.col("__rank").alias(f"__{s}_rank"), F.col("__upto").alias(f"__{s}_upto"))
    x, y = side("x").filter("__x_upto > __x_rank"), side("y").drop("__y_upto")
    x = x.withColumn("__y_rank", F.explode(F.sequence(F.col("__x_rank") + 1, F.col("__x_upto").cast("int"))))
    pairs = x.join(y, ["__key", "__y_rank"])
    name = lambda s: F.struct(F.col(f"__{s}")["serial"], F.col(f"__{s}")["deployment_number"])
    first, second = F.when(name("x") < name("y"), F.col("__x")).otherwise(F.col("__y")), F.when(name("x") < name("y"), F.col("__y")).otherwise(F.col("__x"))
    found = pairs.filter(name("x") != name("y")).select(first.alias("a"), second.alias("b"))
    return found.select(*(F.col(s)[c].alias(f"{s}_{c}") for s in "ab" for c in deployments.columns))
