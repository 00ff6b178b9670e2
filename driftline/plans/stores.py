"""Queries that pass the driver's tables through text files and stored tables and read them back."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.operators.grid import A_AXIS, FLATTENING, SCALE, cell_weights
from driftline.plans import views as v
from driftline.plans.files import _PROVIDER, ORACLES, QUERIES
from driftline.plans.registry import query
from driftline.session import scratch
from driftline.sources import text, zones

__all__ = ["ORACLES", "QUERIES"]

_ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _as_files(rows: DataFrame, label: str) -> str:
    """``rows`` as CSV files with a header, a line of units among them."""
    path = scratch(rows.sparkSession, label)
    head = rows.sparkSession.range(1).select(*(F.lit("UTC" if c == "time" else "unit").alias(c) for c in rows.columns))
    head.unionByName(rows.select(*(F.col(c).cast("string").alias(c) for c in rows.columns))).write.option("header", True).csv(path)
    return path


# --- stored tables --------------------------------------------------------------------------------

_HOURS = v.SQL_OBS.replace("ts AS timestamp", "date_trunc('hour', ts)::TIMESTAMP AS timestamp, event_id % 2 AS batch")


@query(f"""WITH {_HOURS}, o AS (SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY source, site_id, parameter, timestamp, depth_m ORDER BY fetch_run_id DESC, batch DESC, value DESC NULLS LAST) = 1)
SELECT timestamp, site_id, parameter, value, depth_m, (CASE WHEN value IS NULL THEN 9 ELSE 2 END)::TINYINT AS qc_flag, '' AS qc_tests, source, fetch_run_id FROM o""")
def observations_stored(spark, sf_dir):
    root = scratch(spark, "observations")
    for batch in (0, 1):
        rows = v.obs(spark, sf_dir, F.col("event_id") % 2 == batch)
        hours = rows.withColumn("timestamp", F.date_trunc("hour", "timestamp").cast("timestamp_ntz"))
        zones.write_observations(zones.dedupe(hours), root)
    return zones.read_observations(spark, root)


@query("""SELECT 'src' || (user_id % 2) AS source, user_id % 10 AS site_id, count(*) * (CASE WHEN user_id % 2 = 1 THEN 10 ELSE 1 END) AS n FROM events GROUP BY user_id % 2, user_id % 10""")
def feature_table_rebuilt(spark, sf_dir):
    root = scratch(spark, "features")
    built = v.read(spark, sf_dir, "events").groupBy(F.concat(F.lit("src"), F.col("user_id") % 2).alias("source"), (F.col("user_id") % 10).alias("site_id")).agg(F.count("*").alias("n"))
    zones.write_features(built, root, "quarterly_env", ["source", "site_id"], ["src0", "src1"])
    again = built.filter("source = 'src1'").withColumn("n", F.col("n") * 10)
    zones.write_features(again, root, "quarterly_env", ["source", "site_id"], ["src1"])
    return zones.read_features(spark, root, "quarterly_env", "source string, site_id bigint, n bigint")


@query("SELECT DISTINCT l_returnflag AS source FROM lineitem")
def sources_stored(spark, sf_dir):
    root = scratch(spark, "sources")
    zones.write_observations(v.obs_long(spark, sf_dir), root)
    return zones.stored_sources(spark, root)


@query("SELECT o_orderstatus AS file, count(*) AS n_rows, 'run-' || (o_orderkey % 2) AS run_id FROM orders GROUP BY ALL")
def audit_of_runs(spark, sf_dir):
    root = scratch(spark, "audit")
    for run in (0, 1):
        files = v.read(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 2 == run).groupBy(F.col("o_orderstatus").alias("file")).agg(F.count("*").alias("n_rows"))
        zones.append_audit(files, root, "run_files", f"run-{run}")
    return spark.read.schema("file string, n_rows bigint, run_id string").parquet(f"{root}/run_files")


# --- text files -----------------------------------------------------------------------------------

_DEPTHS = text.DEPTH_COLUMNS


@query(f"""SELECT o_orderdate AS timestamp, 'mooring' AS site_id, 'sea_water_temperature' AS parameter, CASE WHEN (o_orderkey + d) % 5 <> 0 THEN o_orderkey / 4.0::DOUBLE + d END AS value, d AS depth_m,
(CASE WHEN (o_orderkey + d) % 5 <> 0 THEN 2 ELSE 9 END)::TINYINT AS qc_flag, '' AS qc_tests, 'depth_columns' AS source, 'run-0' AS fetch_run_id FROM orders, (SELECT unnest([{', '.join(f'{d}::DOUBLE' for d in _DEPTHS.values())}]) AS d)""")
def depth_columns_read(spark, sf_dir):
    k = F.col("o_orderkey")
    cells = [F.when((k + int(d)) % 5 != 0, (k / 4.0 + d).cast("string")).otherwise("NaN").alias(c) for c, d in _DEPTHS.items()]
    rows = v.read(spark, sf_dir, "orders").select(F.date_format("o_orderdate", _ISO).alias("time"), F.lit("32.9").alias("latitude"), F.lit("-117.3").alias("longitude"), *cells)
    return text.depth_columns(spark, _as_files(rows, "columns"), "mooring")


@query("""SELECT o_orderdate AS timestamp, 32 + (o_custkey % 40) * 0.01::DOUBLE AS latitude, -117.0::DOUBLE AS longitude, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey / 8.0::DOUBLE END AS value FROM orders""")
def grid_read(spark, sf_dir):
    value = F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderkey") / 8.0).otherwise(-7.768)
    rows = v.read(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", _ISO).alias("time"), (32 + F.col("o_custkey") % 40 * 0.01).alias("latitude"), F.lit(-117.0).alias("longitude"), value.alias("analysed_sst")
    )
    return text.grid(spark, _as_files(rows, "grid")).drop("site_id")


_PROFILE = f"""{_PROVIDER}, r AS (SELECT event_id, date_trunc('minute', ts)::TIMESTAMP AS timestamp, 5.0::DOUBLE * (user_id % 3 + 1) AS depth_m, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events WHERE user_id % 3 < 2),
k AS (SELECT *, bool_or(value IS NOT NULL) OVER (PARTITION BY timestamp) AS has_any FROM r),
prof AS (SELECT timestamp, 'unknown' AS site_id, 'sea_water_temperature' AS parameter, value, depth_m, (CASE WHEN value IS NULL THEN 9 ELSE [1, 3, 4][event_id % 3 + 1] END)::TINYINT AS qc_flag, qc_tests, p.qc_flag AS own, 'moored_profile' AS source, 'run-0' AS fetch_run_id
FROM k JOIN p USING (event_id) WHERE has_any)"""


def _profile(spark, sf_dir):
    """Moored profiles written from ``events``; two of three depths are declared."""
    e = v.read(spark, sf_dir, "events")
    k = F.col("event_id")
    rows = e.select(
        F.date_format(F.date_trunc("minute", "ts"), _ISO).alias("time"), F.lit("32.9").alias("latitude"), F.lit("-117.3").alias("longitude"), (-5.0 * (F.col("user_id") % 3 + 1)).alias("z"),
        F.when(k % 7 != 0, F.col("value").cast("string")).otherwise("NaN").alias("sea_water_temperature"), F.get(F.array(F.lit(1), F.lit(3), F.lit(4)), (k % 3).cast("int")).alias("sea_water_temperature_qc_agg"),
        F.when(k % 10 == 0, "12").otherwise(F.translate(F.lpad(k.cast("string"), 11, "0"), "05678", "12349")).alias("sea_water_temperature_qc_tests"),
    )
    declared = spark.createDataFrame([("unknown", 5.0), ("unknown", 10.0)], "site_id string, depth_m double")
    return text.moored_profile(spark, _as_files(rows, "profile"), declared)


@query(f"WITH {_PROFILE} SELECT timestamp, site_id, parameter, value, depth_m, qc_flag, qc_tests, source, fetch_run_id FROM prof")
def profile_read(spark, sf_dir):
    return _profile(spark, sf_dir)


@query(f"WITH {_PROFILE} SELECT site_id, count(*) FILTER (WHERE qc_flag <> 9 AND qc_flag <> own) AS n_disagree, count(*) AS n_rows FROM prof GROUP BY 1")
def provider_disagreements(spark, sf_dir):
    return text.provider_disagreement(_profile(spark, sf_dir))


# --- files whose head lines name their columns -------------------------------------------------------


def _headed_files(lines: DataFrame, head: str, label: str, parts: int = 3) -> str:
    """Text files of ``lines`` (one column), each below the head."""
    def below(batches):
        yield pa.RecordBatch.from_arrays([pa.array([head])], names=["value"])
        yield from (pa.RecordBatch.from_arrays(b.columns, names=["value"]) for b in batches)

    path = scratch(lines.sparkSession, label)
    lines.toDF("value").repartition(parts).mapInArrow(below, "value string").write.text(path)
    return path



@query("""WITH r AS (SELECT date_trunc('minute', ts)::TIMESTAMP AS timestamp, CASE WHEN event_id % 7 <> 0 THEN (event_id % 400) / 10.0::DOUBLE END AS w, CASE WHEN event_id % 5 <> 0 THEN (event_id % 90) / 10.0::DOUBLE END AS h FROM events),
p AS (SELECT timestamp, 'sea_water_temperature' AS parameter, w AS value, 0.5::DOUBLE AS depth_m FROM r UNION ALL SELECT timestamp, 'wave_significant_height', h, NULL FROM r)
SELECT timestamp, parameter, value, depth_m, (CASE WHEN value IS NULL THEN 9 ELSE 2 END)::TINYINT AS qc_flag, '' AS qc_tests, 'buoy' AS source, 'run-0' AS fetch_run_id FROM p""")
def buoy_read(spark, sf_dir):
    k = F.col("event_id")
    tenths = lambda n: F.format_string("%d.%d", F.floor(n / 10), n % 10)
    found = None
    for archive, names, units in (
        (0, "#YY  MM DD hh mm WDIR WSPD WVHT DPD WTMP PTDY", "#yr  mo dy hr mn degT m/s m sec degC hPa"), (1, "#YY  MM DD hh mm WTMP WVHT", "#yr  mo dy hr mn degC m"),
    ):
        wave = F.when(k % 5 != 0, tenths(k % 90)).otherwise("99.00" if archive else "MM")
        water = F.when(k % 7 != 0, tenths(k % 400)).otherwise("999.0" if archive else "MM")
        cells = [water, wave] if archive else [F.lit("MM"), F.lit("3.0"), wave, F.lit("8"), water, F.lit("-1.0")]
        lines = v.read(spark, sf_dir, "events").filter(k % 2 == archive).select(F.concat_ws(" ", F.date_format("ts", "yyyy MM dd HH mm"), *cells))
        path = _headed_files(lines, f"{names}\n{units}", "buoy")
        files = spark.read.text(path).select(F.regexp_extract("_metadata.file_name", r"^([^_h.]+)", 1).alias("station")).distinct()
        declared = [F.struct(F.lit(p).alias("parameter"), F.lit(d).cast("double").alias("depth_m")) for p, d in (("sea_water_temperature", 0.5), ("wave_significant_height", None))]
        rows = text.buoy(spark, path, files.select("station", F.inline(F.array(*declared))), range_bytes=1 << 16).drop("site_id")
        found = rows if found is None else found.unionByName(rows)
    return found


@query("""SELECT year(o_orderdate)::INT AS year, quarter(o_orderdate)::TINYINT AS quarter, CASE WHEN count(*) FILTER (WHERE o_orderstatus <> 'P') > 0 THEN round(sum(o_totalprice), 2) END AS area_m2,
CASE WHEN count(*) FILTER (WHERE o_orderstatus <> 'P') > 0 THEN (count(*) FILTER (WHERE o_orderstatus = 'F'))::DOUBLE END AS n_cells_canopy, (count(*) FILTER (WHERE o_orderstatus <> 'P'))::INT AS n_cells_observed, count(*)::INT AS n_cells, 'P' AS polygon_id
FROM orders GROUP BY o_custkey % 6, 1, 2""")
def canopy_read(spark, sf_dir):
    landed = v.canopy_landed(spark, sf_dir)
    area = F.format_string("%.2f", "area_m2")
    line = lambda q, a: F.concat_ws(",", "year", q, a, "n_cells_canopy", "n_cells_observed", "n_cells")
    lines = landed.select(line(F.col("quarter"), area)).union(landed.filter("quarter = 1").select(line(F.lit("max"), area)))
    path = _headed_files(lines, ",".join(text.CANOPY_COLUMNS), "canopy")
    polygons = spark.read.text(path).select(F.col("_metadata.file_name").alias("file")).distinct().withColumn("polygon_id", F.lit("P"))
    return text.canopy(spark, path, polygons).drop("file")


@query("""WITH d AS (SELECT o_orderdate::DATE AS day, count(*) AS n, sum(o_orderkey)::BIGINT AS s FROM orders GROUP BY 1),
r AS (SELECT day::TIMESTAMP + CASE WHEN n % 3 = 0 THEN INTERVAL '18 hours 38 minutes' ELSE INTERVAL '17 hours 5 minutes' END AS timestamp, CASE WHEN n % 3 <> 0 THEN 0 END AS tf, 0.5::DOUBLE AS depth_m, n % 30 + 0.5::DOUBLE AS value, n % 6 AS flag FROM d
UNION ALL SELECT day::TIMESTAMP + CASE WHEN n % 3 = 0 THEN INTERVAL '18 hours 38 minutes' ELSE INTERVAL '17 hours 5 minutes' END, CASE WHEN n % 3 <> 0 THEN 0 END, 5.0, CASE WHEN s % 4 <> 0 THEN s % 25 END, CASE WHEN s % 8 <> 0 THEN s % 6 END FROM d),
t AS (SELECT *, CASE WHEN value IS NULL THEN 'missing' WHEN flag = 0 THEN 'pass' WHEN flag < 5 THEN 'suspect' WHEN flag = 5 THEN 'fail' END AS st, CASE WHEN tf = 0 THEN 'pass' END AS tt FROM r WHERE value IS NOT NULL OR flag IS NOT NULL)
SELECT timestamp, 'pier' AS site_id, 'sea_water_temperature' AS parameter, value, depth_m, (CASE WHEN st = 'missing' THEN 9 WHEN st = 'fail' THEN 4 WHEN st = 'suspect' THEN 3 WHEN st = 'pass' OR tt = 'pass' THEN 1 ELSE 2 END)::TINYINT AS qc_flag,
concat_ws(';', 'source_flag:' || st, 'time_flag:' || tt) AS qc_tests, 'shore_archive' AS source, 'run-0' AS fetch_run_id FROM t""")
def shore_read(spark, sf_dir):
    days = v.read(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("s"))
    n, s = F.col("n"), F.col("s")
    timed = n % 3 != 0
    cells = [
        F.year("day"), F.month("day"), F.dayofmonth("day"), F.when(timed, "905").otherwise(""), F.when(timed, "0").otherwise(""), F.format_string("%d.5", n % 30), n % 6,
        F.when(s % 4 != 0, (s % 25).cast("string")).otherwise("NaN"), F.when(s % 8 != 0, (s % 6).cast("string")).otherwise(""), F.lit(""),
    ]
    head = "\ufeffStation: a pier\nPosition: 32° 52' 00\" N 117° 15' 30\" W\nSurface depth 0.5 m\n" + ",".join(text.SHORE_COLUMNS) + ","
    path = _headed_files(days.select(F.concat_ws(",", *(c.cast("string") for c in cells))), head, "shore")
    return text.shore_archive(spark, path, 0.5, 5.0, "pier", range_bytes=1 << 14)


# --- areas of grid cells -----------------------------------------------------------------------------

_N = FLATTENING / (2 - FLATTENING)
_ECC = 2 * _N**0.5 / (1 + _N)
_SERIES = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180, 13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440, 61 * _N**3 / 240 - 103 * _N**4 / 140, 49561 * _N**4 / 161280)
_RADIUS = SCALE * A_AXIS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)


@query(f"""WITH g AS (SELECT DISTINCT 32 + (o_custkey % 40) * 0.01::DOUBLE AS latitude, -117.5::DOUBLE + (o_orderkey % 50) * 0.01::DOUBLE AS longitude FROM orders),
c AS (SELECT latitude, longitude, i, radians(latitude + [-0.005, -0.005, 0.005, 0.005][i]) AS phi, radians(longitude + [-0.005, 0.005, 0.005, -0.005][i] + 117) AS lam FROM g, (SELECT unnest([1, 2, 3, 4]) AS i)),
t AS (SELECT *, sinh(atanh(sin(phi)) - {_ECC!r}::DOUBLE * atanh({_ECC!r}::DOUBLE * sin(phi))) AS t FROM c),
x AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM t),
e AS (SELECT latitude, longitude, i, {_RADIUS!r}::DOUBLE * (eta + {' + '.join(f'{a!r}::DOUBLE * cos({2 * j} * xi) * sinh({2 * j} * eta)' for j, a in enumerate(_SERIES, 1))}) AS x,
  {_RADIUS!r}::DOUBLE * (xi + {' + '.join(f'{a!r}::DOUBLE * sin({2 * j} * xi) * cosh({2 * j} * eta)' for j, a in enumerate(_SERIES, 1))}) AS y FROM x),
q AS (SELECT latitude, longitude, list(x - x0 ORDER BY i) AS x, list(y - y0 ORDER BY i) AS y FROM (SELECT *, first(x) OVER w AS x0, first(y) OVER w AS y0 FROM e WINDOW w AS (PARTITION BY latitude, longitude ORDER BY i)) GROUP BY 1, 2)
SELECT round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, round(abs(list_sum(list_transform([1, 2, 3, 4], lambda i: x[i] * y[i % 4 + 1] - x[i % 4 + 1] * y[i]))) / 2, 1) AS weight FROM q""")
def cell_areas(spark, sf_dir):
    """Areas of whole cells in their UTM zone."""
    cells = v.read(spark, sf_dir, "orders").select((32 + F.col("o_custkey") % 40 * 0.01).alias("latitude"), (-117.5 + F.col("o_orderkey") % 50 * 0.01).alias("longitude"))
    whole = [(-118.0, 31.0), (-116.0, 31.0), (-116.0, 33.0), (-118.0, 33.0)]
    return cell_weights(cells, whole).withColumn("weight", F.round("weight", 1))
