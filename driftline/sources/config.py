"""Declared settings from JSON as small dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PARAMETER = (
    "parameters map<string, struct<unit: string, valid_range: array<double>, qc: struct<spike: struct<suspect: double, fail: double>, "
    "rate_of_change: struct<suspect_per_hour: double, fail_per_hour: double>, by_source: map<string, map<string, string>>>>>"
)
_FEATURES = (
    "policy struct<coverage_floor: double, baseline: struct<start_year: int, end_year: int, min_years: int>, "
    "baseline_overrides: map<string, string>>, parameters map<string, string>"
)
_SITES = "sites array<struct<site_id: string, latitude: double, longitude: double, depths_m: array<double>, same_platform_as: array<string>, neighbor_refs: array<string>, operator: string, code: string>>"


def _json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def parameters(spark: SparkSession, path: str) -> DataFrame:
    """One row for each parameter: unit, range and thresholds."""
    return _json(spark, path, _PARAMETER).select(F.explode("parameters").alias("parameter", "p")).filter("p is not null and not startswith(parameter, '_')").select(
        "parameter", "p.unit", F.get("p.valid_range", 0).alias("valid_min"), F.get("p.valid_range", 1).alias("valid_max"), F.col("p.qc.spike.suspect").alias("spike_suspect"),
        F.col("p.qc.spike.fail").alias("spike_fail"), F.col("p.qc.rate_of_change.suspect_per_hour").alias("rate_suspect"), F.col("p.qc.rate_of_change.fail_per_hour").alias("rate_fail"),
    )


def feature_policy(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, _FEATURES).select("policy.coverage_floor", "policy.baseline.*")


def source_exceptions(spark: SparkSession, path: str) -> DataFrame:
    """parameter, source, test of each exception: suppressed where it is null, else its own thresholds."""
    rows = _json(spark, path, _PARAMETER).select(F.explode("parameters").alias("parameter", "p")).filter("not startswith(parameter, '_')")
    rows = rows.select("parameter", F.explode("p.qc.by_source").alias("source", "tests")).filter("not startswith(source, '_')")
    rows = rows.select("parameter", "source", F.explode("tests").alias("test", "j")).filter("not startswith(test, '_')")
    limit = lambda k: F.coalesce(F.get_json_object("j", f"$.{k}"), F.get_json_object("j", f"$.{k}_per_hour")).try_cast("double")
    none = F.col("j").isNull() | (F.col("j") == "null")
    return rows.select("parameter", "source", "test", none.alias("suppressed"), limit("suspect").alias("suspect"), limit("fail").alias("fail"))


def baseline_overrides(spark: SparkSession, path: str) -> DataFrame:
    """series (a site or polygon) with its own baseline window."""
    rows = _json(spark, path, _FEATURES).select(F.explode("policy.baseline_overrides").alias("series", "j")).filter("not startswith(series, '_')")
    year = lambda k: F.get_json_object("j", f"$.{k}").cast("int").alias(k)
    return rows.select("series", year("start_year"), year("end_year"))


def thresholds(spark: SparkSession, path: str) -> DataFrame:
    """parameter, kind and bounds (one number, or two for a band) of each declared threshold."""
    rows = _json(spark, path, _FEATURES).select(F.explode("parameters").alias("parameter", "j")).filter("not startswith(parameter, '_')")
    kinds = F.from_json(F.get_json_object("j", "$.thresholds"), "map<string, array<string>>")
    rows = rows.select("parameter", F.explode(kinds).alias("kind", "values")).filter("not startswith(kind, '_')")
    bounds = F.when(F.col("b").startswith("["), F.from_json("b", "array<double>")).otherwise(F.array(F.col("b").try_cast("double")))
    return rows.select("parameter", "kind", F.explode("values").alias("b")).select("parameter", "kind", bounds.alias("bounds"))


def polygons(spark: SparkSession, path: str) -> DataFrame:
    """polygon_id, purpose, site_ids, file and outline (longitude, latitude) of each feature of a GeoJSON file."""
    schema = (
        "features array<struct<properties: struct<polygon_id: string, purpose: string, site_ids: array<string>, source_file: string, name: string>, "
        "geometry: struct<type: string, coordinates: array<array<array<double>>>>>>"
    )
    f = _json(spark, path, schema).select(F.explode("features").alias("f"))
    return f.select("f.properties.polygon_id", "f.properties.purpose", "f.properties.site_ids", F.col("f.properties.source_file").alias("file"), F.get("f.geometry.coordinates", 0).alias("outline"))


def polygon_sites(polygons_: DataFrame) -> DataFrame:
    return polygons_.select("polygon_id", F.explode("site_ids").alias("site_id"))


def feature_sets(spark: SparkSession, path: str) -> DataFrame:
    """parameter, feature_set and role of each declared parameter."""
    rows = _json(spark, path, _FEATURES).select(F.explode("parameters").alias("parameter", "j")).filter("not startswith(parameter, '_')")
    return rows.select("parameter", F.get_json_object("j", "$.feature_set").alias("feature_set"), F.coalesce(F.get_json_object("j", "$.role"), F.lit("predictor")).alias("role"))


def sites(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, _SITES).select(F.explode("sites").alias("s")).select("s.*")


def site_depths(sites_: DataFrame) -> DataFrame:
    return sites_.select("site_id", F.explode("depths_m").alias("depth_m"))


def platform_kin(sites_: DataFrame) -> DataFrame:
    return sites_.select(F.col("site_id").alias("a"), F.explode("same_platform_as").alias("b"))
