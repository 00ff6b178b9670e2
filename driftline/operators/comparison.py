"""The response joined to every predictor at several lags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions import calendar
from driftline.functions.stats import null_safe_join
from driftline.operators.quality import SERIES

LAGS = (0, 1, 2, 3, 4)


def pairs(quarterly: DataFrame, polygon_site: DataFrame) -> DataFrame:
    """Distinct series of the sites that a polygon declares."""
    return quarterly.select(*SERIES).distinct().join(polygon_site, "site_id")


def build_comparison(canopy: DataFrame, quarterly: DataFrame, polygon_site: DataFrame, anomalies: list[str], lags=LAGS) -> DataFrame:
    """polygon x series x quarter x lag with the predictor's anomalies of ``lag`` quarters before.

    All lags are one join: the grid is exploded over the lags and meets the
    predictors once, null-safe on the series. A quarter before the record gives a
    row with a null predictor side. Nothing is filtered.
    """
    response = canopy.select(
        "polygon_id", "year", "quarter", F.col("usable").alias("canopy_usable"), "area_m2", F.col("area_m2_anom").alias("canopy_anom")
    )
    grid = pairs(quarterly, polygon_site).join(response, "polygon_id").withColumn("lag", F.explode(F.array(*map(F.lit, lags))))
    year, quarter = calendar.shift_quarter(F.col("year"), F.col("quarter"), -F.col("lag"))
    grid = grid.withColumn("env_year", year).withColumn("env_quarter", quarter)
    env = quarterly.select(
        *SERIES, F.col("year").alias("env_year"), F.col("quarter").alias("env_quarter"), F.col("usable").alias("env_usable"), *anomalies
    )
    return null_safe_join(grid, env, [*SERIES, "env_year", "env_quarter"])


def gate() -> Column:
    """Both sides usable and the response has an anomaly."""
    return F.col("canopy_usable") & F.coalesce("env_usable", F.lit(False)) & F.col("canopy_anom").isNotNull()


def attrition(comparison: DataFrame) -> DataFrame:
    """Nested counts of the gate's steps and of what lags reach, in one pass."""
    response, present, env = F.col("canopy_usable"), F.col("env_usable").isNotNull(), F.coalesce("env_usable", F.lit(False))
    return comparison.agg(
        F.count("*").alias("n_rows"), F.count_if(response).alias("n_response_usable"), F.count_if(response & present).alias("n_predictor_present"),
        F.count_if(response & env).alias("n_predictor_usable"), F.count_if(gate()).alias("n_gated"),
        F.count_if(response & ~present).alias("n_predictor_missing"), F.count_if(gate() & (F.col("lag") == 0)).alias("n_gated_lag0"),
        F.count_distinct(F.when(gate(), F.struct("polygon_id", "year", "quarter"))).alias("n_quarters_reached"),
    )


def agreement(comparison: DataFrame, canopy: DataFrame) -> DataFrame:
    """Response quarters of the gated table and how many differ from the response table."""
    gated = comparison.filter(gate()).select("polygon_id", "year", "quarter", "canopy_anom").distinct()
    other = canopy.select("polygon_id", "year", "quarter", "area_m2_anom")
    return gated.join(other, ["polygon_id", "year", "quarter"], "left").agg(
        F.count("*").alias("n_quarters"), F.count_if(~F.col("canopy_anom").eqNullSafe(F.col("area_m2_anom"))).alias("n_different")
    )


def reached_by_lag_only(comparison: DataFrame) -> DataFrame:
    """Response quarters that only a lag above 0 reaches."""
    gated = comparison.filter(gate())
    key = ["polygon_id", "year", "quarter"]
    return gated.filter("lag > 0").select(*key).distinct().join(gated.filter("lag = 0").select(*key).distinct(), key, "left_anti")
