"""Observation-shaped views of the driver's tables, and the declared settings of the queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NOW = "2030-01-01"
FLOOR = 0.2

PARAMETERS = {
    "click": {"valid_range": (0.0, 250.0), "suspect_span": (0.0, 200.0), "spike": (60.0, 150.0), "rate_per_hour": (30.0, 200.0)},
    "view": {"valid_range": (0.0, 250.0), "spike": (60.0, 150.0), "rate_per_hour": (30.0, 200.0), "by_source": {"src1": ("spike",)}},
    "purchase": {"valid_range": (1.0, 200.0), "spike": (80.0, 160.0), "by_source": {"src9": ("spike",)}},
    "error": {"valid_range": (0.0, 300.0)},
}
FEATURES = {
    "click": {"days_above": (100.0, 150.0), "days_below": (10.0,), "degree_days_above": (45.0,), "max_spell_above": (60.0,), "time_in_band": ((10.0, 60.0),)},
    "view": {},
    "purchase": {},
    "error": {},
}
LONG_FEATURES = {"O": {"days_above": (45.0,), "time_in_band": ((10.0, 40.0),)}, "F": {}}
BASELINE = {"start_year": 1995, "end_year": 2000, "min_years": 3, "overrides": {"S2": {"start_year": 1996, "end_year": 2001}}}
POLYGON_SITES = [(f"P{p}", f"S{s}") for p in range(6) for s in range(5) if (p + s) % 2 == 0]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str, of: Column | None = None) -> DataFrame:
    """Sensor-like observations from ``events``, or from those of one batch."""
    events = read(spark, sf_dir, "events")
    value = F.when(F.col("event_id") % 97 != 0, F.col("value"))
    return (events if of is None else events.filter(of)).select(
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("S"), F.col("user_id") % 10).alias("site_id"),
        F.col("event_type").alias("parameter"),
        value.alias("value"),
        F.when(~F.col("event_type").isin("error", "signup"), 5.0 * (F.col("user_id") % 3)).alias("depth_m"),
        F.when(value.isNull(), 9).otherwise(2).cast("tinyint").alias("qc_flag"),
        F.lit("").alias("qc_tests"),
        F.concat(F.lit("src"), F.col("user_id") % 2).alias("source"),
        F.concat(F.lit("run-"), F.col("event_id") % 3).alias("fetch_run_id"),
    )


def obs_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations over several years from ``lineitem``, one for each identity (the largest wins)."""
    raw = read(spark, sf_dir, "lineitem").select(
        (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("l_orderkey") % 86400).cast("decimal(18,6)"))).alias("timestamp"),
        F.concat(F.lit("S"), F.col("l_suppkey") % 5).alias("site_id"), F.col("l_linestatus").alias("parameter"),
        F.col("l_returnflag").alias("source"), F.col("l_quantity").cast("double").alias("value"),
    )
    return raw.groupBy("timestamp", "site_id", "parameter", "source").agg(F.max("value").alias("value")).select(
        "timestamp", "site_id", "parameter", "value", F.lit(None).cast("double").alias("depth_m"),
        F.lit(2).cast("tinyint").alias("qc_flag"), F.lit("").alias("qc_tests"), "source", F.lit("run-0").alias("fetch_run_id"),
    )


def canopy_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly response by polygon from ``orders``."""
    return (
        read(spark, sf_dir, "orders").groupBy(
            F.concat(F.lit("P"), F.col("o_custkey") % 6).alias("polygon_id"), F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").cast("tinyint").alias("quarter"),
        ).agg(F.round(F.sum("o_totalprice"), 2).alias("area_m2"), F.count_if(F.col("o_orderstatus") == "F").alias("n_cells_canopy"),
              F.count_if(F.col("o_orderstatus") != "P").alias("n_cells_observed"), F.count("*").alias("n_cells"))
    )


def polygon_site(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(POLYGON_SITES, "polygon_id string, site_id string")


def deployments(spark: SparkSession) -> DataFrame:
    rows = [
        (f"S{s}", f"T{s}", 1, p, d, f"2024-01-{a:02d} 06:30:00", f"2024-01-{b:02d} 18:15:00")
        for s, a, b in ((1, 3, 12), (4, 5, 25), (7, 2, 28)) for p, d in (("click", 0.0), ("click", 5.0), ("view", 10.0), ("error", None))
    ]
    return spark.createDataFrame(rows, "site_id string, serial string, deployment_number long, parameter string, depth_m double, a string, b string").select(
        "site_id", "serial", "deployment_number", "parameter", "depth_m", F.col("a").cast("timestamp_ntz").alias("w_start"), F.col("b").cast("timestamp_ntz").alias("w_end")
    )


# --- the same views in DuckDB's SQL -----------------------------------------------------------

SQL_OBS = """obs AS (
  SELECT ts AS timestamp, 'S' || (user_id % 10) AS site_id, event_type AS parameter, CASE WHEN event_id % 97 <> 0 THEN value END AS value,
         CASE WHEN event_type NOT IN ('error', 'signup') THEN 5.0::DOUBLE * (user_id % 3) END AS depth_m, CASE WHEN event_id % 97 = 0 THEN 9 ELSE 2 END AS qc_flag,
         'src' || (user_id % 2) AS source, 'run-' || (event_id % 3) AS fetch_run_id
  FROM events)"""

SQL_LONG = """obs AS (
  SELECT l_shipdate + to_seconds(l_orderkey % 86400) AS timestamp, 'S' || (l_suppkey % 5) AS site_id, l_linestatus AS parameter, l_returnflag AS source,
         max(l_quantity)::DOUBLE AS value, NULL::DOUBLE AS depth_m, 2 AS qc_flag
  FROM lineitem GROUP BY ALL)"""
