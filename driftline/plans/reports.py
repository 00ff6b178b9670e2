"""More registered queries: what notebooks report of deployments, signals and responses, and checks of files and positions."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.operators import checks, screen, validation
from driftline.plans import registry as reg
from driftline.plans import views as v
from driftline.plans.registry import MEASURED, ORACLES, QUERIES, SQL_CANOPY, SQL_DEP, SQL_QLONG, SQL_SCREEN, D, query

__all__ = ["ORACLES", "QUERIES"]

_D = ", ".join(D)
_RED = SQL_DEP + "," + reg.sql_reduce("drows", D, v.FEATURES, closed=True)

# --- deployments ------------------------------------------------------------------------------------


@query(f"""WITH {_RED}, u AS (SELECT site_id, parameter, min(depth_m) AS shallow_m, arg_min(mean, depth_m) AS shallow, max(depth_m) AS deep_m, arg_max(mean, depth_m) AS deep, count(DISTINCT depth_m) AS n_depths
FROM red WHERE n_obs > 0 AND usable AND depth_m IS NOT NULL GROUP BY ALL)
SELECT site_id, parameter, shallow_m, round(shallow, 6) AS shallow, deep_m, round(deep, 6) AS deep, n_depths, round(shallow - deep, 6) AS difference FROM u""")
def depth_contrast(spark, sf_dir):
    return validation.depth_contrast(reg._deployment(spark, sf_dir))


@query(f"WITH {reg._sql_sub('hour')} SELECT {_D}, round(sum(mean * n_obs) / sum(CASE WHEN mean IS NOT NULL THEN n_obs END), 6) AS mean, sum(n_obs)::BIGINT AS n_obs FROM sub GROUP BY ALL")
def weighted_means(spark, sf_dir):
    return validation.weighted_mean(reg._sub(spark, sf_dir, "hour"), D, "mean")


_DAYS = ["days_above_100c", "days_above_150c", "days_below_10c"]


@query(f"WITH {_RED} SELECT {_D}, n_days_observed, {', '.join(_DAYS)}, {', '.join(f'round({d} / n_days_observed, 6) AS {d}_share' for d in _DAYS)} FROM red WHERE n_obs > 0")
def exposure_shares(spark, sf_dir):
    return validation.exposure_share(reg._deployment(spark, sf_dir), _DAYS)


@query(f"WITH {reg._sql_sub('hour')} SELECT {_D}, hour, coalesce(hour - lag(hour) OVER (PARTITION BY {_D} ORDER BY hour) > INTERVAL 1 HOUR, false) AS breaks FROM sub")
def hourly_breaks(spark, sf_dir):
    hours = reg._sub(spark, sf_dir, "hour").select(*D, "hour")
    return validation.breaks(hours, D, "hour", F.expr("interval 1 hour"))


# --- signals and responses --------------------------------------------------------------------------

_ORDER = f"abs(r) DESC NULLS LAST, polygon_id, {reg._KEYS.replace('depth_m', 'depth_m NULLS LAST')}, lag, feature"


@query(f"WITH {SQL_SCREEN} SELECT * FROM scr WHERE n_eff >= 20 ORDER BY {_ORDER} LIMIT 10")
def strongest_effective_cells(spark, sf_dir):
    return screen.strongest(reg._screen(spark, sf_dir), 10, 20.0)


@query(f"""WITH {SQL_SCREEN}, a AS (SELECT DISTINCT {reg._SIG} FROM scr WHERE n_eff >= 10 AND rank_gap <= 0.03 AND r IS NOT NULL), b AS (SELECT DISTINCT {reg._SIG} FROM scr WHERE n_eff >= 15 AND rank_gap <= 0.10 AND r IS NOT NULL)
SELECT *, 'drops out' AS change FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'enters' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def signal_list_change(spark, sf_dir):
    cells = reg._screen(spark, sf_dir)
    return screen.list_change(screen.signals(screen.eligible(cells, 0.03)), screen.signals(screen.eligible(cells, 0.10, 15.0)))


@query(f"""WITH {SQL_SCREEN}, e AS (SELECT * FROM scr WHERE n_eff >= 10 AND rank_gap <= 0.05 AND r IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {reg._SIG} ORDER BY {_ORDER}) = 1),
t AS (SELECT {reg._SIG} FROM e ORDER BY {_ORDER} LIMIT 3) SELECT scr.* FROM scr SEMI JOIN t USING ({reg._SIG})""")
def signal_members(spark, sf_dir):
    cells = reg._screen(spark, sf_dir)
    return screen.members(cells, screen.top_signals(screen.eligible(cells)))


@query(f"""WITH {SQL_QLONG}, l AS ({' UNION ALL '.join(f"SELECT source, site_id, parameter, depth_m, '{m}' AS feature, {m} AS v FROM ql" for m in MEASURED)}),
w AS (SELECT source, site_id, parameter, depth_m, feature, count(v) AS n_present, count(DISTINCT round(v, 6)) AS n_distinct,
CASE WHEN count(v) = 0 THEN 'not_applicable' WHEN count(DISTINCT round(v, 6)) < 10 THEN 'excluded' WHEN count(DISTINCT round(v, 6)) < 25 THEN 'low_resolution' ELSE 'ok' END AS verdict FROM l GROUP BY ALL)
SELECT * FROM w WHERE feature = 'max' AND verdict <> 'ok'""")
def audit_note_max(spark, sf_dir):
    return screen.audit_note(screen.resolution_audit(reg._qlong(spark, sf_dir), MEASURED), "max")


@query(f"""WITH {SQL_CANOPY}, s AS (SELECT polygon_id, year, quarter, area_m2, area_m2 - avg(area_m2) OVER (PARTITION BY polygon_id) AS c, stddev_samp(area_m2) OVER (PARTITION BY polygon_id) AS sd FROM canopy)
SELECT polygon_id, year, quarter, area_m2, round(CASE WHEN sd > 0 THEN c / sd ELSE c END, 6) AS area_m2_z FROM s""")
def standardised_canopy(spark, sf_dir):
    return validation.standardised(reg._canopy(spark, sf_dir).select("polygon_id", "year", "quarter", "area_m2"), ["polygon_id"], "area_m2")


# --- checks of files ----------------------------------------------------------------------------------

SQL_LOGGER = "lg AS (SELECT 'U' || user_id AS file, event_type AS series, date_trunc('minute', ts)::TIMESTAMP AS timestamp_local, CASE WHEN event_id % 97 <> 0 THEN value END AS value FROM events)"


def _logger(spark, sf_dir):
    """Rows of logger files from ``events``: one file for each user, one series for each type, whole minutes."""
    return v.read(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), "user_id").alias("file"), F.col("event_type").alias("series"), F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("timestamp_local"),
        F.when(F.col("event_id") % 97 != 0, F.col("value")).alias("value"),
    )


@query(f"WITH {SQL_LOGGER} SELECT file, series, count(value) AS n, min(timestamp_local) AS first_at, max(timestamp_local) AS last_at, min(value) AS lo, max(value) AS hi, round(avg(value), 6) AS mean FROM lg GROUP BY ALL")
def file_summaries(spark, sf_dir):
    return checks.file_summary(_logger(spark, sf_dir))


@query(f"""WITH {SQL_LOGGER}, d AS (SELECT *, (epoch_us(timestamp_local) - epoch_us(lag(timestamp_local) OVER (PARTITION BY file ORDER BY timestamp_local))) / 1e6 AS dt FROM lg),
m AS (SELECT file, dt FROM d WHERE dt IS NOT NULL GROUP BY file, dt QUALIFY row_number() OVER (PARTITION BY file ORDER BY count(*) DESC, dt) = 1),
o AS (SELECT file, string_agg(epoch_us(timestamp_local)::VARCHAR, ',' ORDER BY timestamp_local) AS first_off FROM (SELECT * FROM d WHERE dt <> 600 QUALIFY row_number() OVER (PARTITION BY file ORDER BY timestamp_local) <= 3) GROUP BY 1)
SELECT file, any_value(m.dt) AS usual_s, count(*) FILTER (WHERE d.dt <> 600) AS n_off, count(*) FILTER (WHERE d.dt > 600) AS n_gaps, coalesce(any_value(first_off), '') AS first_off
FROM d LEFT JOIN m USING (file) LEFT JOIN o USING (file) GROUP BY file""")
def cadence_audits(spark, sf_dir):
    audit = checks.cadence_audit(_logger(spark, sf_dir).withColumn("interval_s", F.lit(600.0)))
    at = F.transform("first_off", lambda t: F.unix_micros(t.cast("timestamp")).cast("string"))
    return audit.select("file", "usual_s", "n_off", "n_gaps", F.array_join(at, ",").alias("first_off"))


@query(f"""WITH {SQL_CANOPY} SELECT polygon_id AS file, count(*) - count(DISTINCT (year, quarter)) AS repeated, count(DISTINCT n_cells) - 1 AS footprints, count(*) FILTER (WHERE n_cells_observed > n_cells) AS observed_over_footprint,
count(*) FILTER (WHERE n_cells_canopy > n_cells_observed) AS canopy_over_observed, count(*) FILTER (WHERE area_m2 > 900.0 * n_cells_canopy) AS area_over_cells, count(*) FILTER (WHERE area_m2 IS NULL OR n_cells IS NULL) AS unreadable FROM landed GROUP BY 1""")
def canopy_count_faults(spark, sf_dir):
    return checks.canopy_counts(v.canopy_landed(spark, sf_dir).withColumnRenamed("polygon_id", "file"))


@query("""WITH n AS (SELECT 'P' || (o_custkey % 6) AS file, count(*) AS n_in, count(*) FILTER (WHERE o_orderstatus = 'P') AS n_out FROM orders GROUP BY 1)
SELECT file, n_in, n_out, CASE WHEN n_out = 0 THEN 'failure' ELSE 'ok' END AS outcome FROM n""")
def rows_in_and_out(spark, sf_dir):
    rows = v.read(spark, sf_dir, "orders").select(F.concat(F.lit("P"), F.col("o_custkey") % 6).alias("file"), F.col("o_orderkey").alias("line"), "o_orderstatus")
    return checks.rows_in_out(rows, rows.filter("o_orderstatus = 'P'"))


@query("""WITH d AS (SELECT DISTINCT event_type, user_id FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY user_id) AS rn FROM d)
SELECT event_type, string_agg(user_id::VARCHAR, ',' ORDER BY user_id) AS examples FROM r WHERE rn <= 5 GROUP BY 1""")
def first_examples(spark, sf_dir):
    found = checks.first_values(v.read(spark, sf_dir, "events"), "event_type", "user_id")
    return found.withColumn("examples", F.array_join(F.col("examples").cast("array<string>"), ","))


@query("SELECT event_type AS parameter, count(*) AS n_rows FROM events WHERE event_type NOT IN ('click', 'view', 'purchase', 'error') GROUP BY 1")
def undeclared_parameters(spark, sf_dir):
    seen = v.obs(spark, sf_dir).groupBy("parameter").agg(F.count("*").alias("n_rows"))
    return checks.unknown_parameters(seen, list(v.PARAMETERS))


# --- positions and ownership ----------------------------------------------------------------------------


@query("""WITH f AS (SELECT c_custkey::VARCHAR AS file, 32 + (c_custkey % 40) * 0.001::DOUBLE AS lat, -117 - c_nationkey * 0.001::DOUBLE AS lon FROM customer),
s AS (SELECT 'N' || (n_nationkey // 2) AS site_id, 32.0002::DOUBLE + n_nationkey * 0.001::DOUBLE AS slat, -117.0002::DOUBLE - (n_nationkey % 5) * 0.001::DOUBLE AS slon FROM nation),
h AS (SELECT file, count(*) AS n, min(site_id) AS site_id FROM f JOIN s ON abs(lat - slat) <= 0.0005 AND abs(lon - slon) <= 0.0005 GROUP BY 1)
SELECT f.file, CASE WHEN n = 1 THEN site_id END AS site_id, CASE WHEN n = 1 THEN 'accepted' ELSE 'quarantined' END AS outcome, coalesce(n, 0) AS n_sites FROM f LEFT JOIN h USING (file)""")
def positions_matched(spark, sf_dir):
    files = v.read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("file"), (32 + (F.col("c_custkey") % 40) * 0.001).alias("lat"), (-117 - F.col("c_nationkey") * 0.001).alias("lon")
    )
    key = F.col("n_nationkey")
    sites = v.read(spark, sf_dir, "nation").select(
        F.concat(F.lit("N"), F.floor(key / 2)).alias("site_id"), (32.0002 + key * 0.001).alias("lat"), (-117.0002 - (key % 5) * 0.001).alias("lon")
    )
    return checks.match_site(files, sites)


@query("""WITH y AS (SELECT DISTINCT 'P' || (o_custkey % 6) AS station, year(o_orderdate)::INT AS year FROM orders)
SELECT station, year, CASE WHEN year < 1994 THEN 'old' WHEN year < 1997 THEN 'mid' ELSE 'new' END AS dataset FROM y""")
def dataset_owners(spark, sf_dir):
    years = v.read(spark, sf_dir, "orders").select(F.concat(F.lit("P"), F.col("o_custkey") % 6).alias("station"), F.year("o_orderdate").alias("year")).distinct()
    sets = spark.createDataFrame([(s, d, e) for s in ("P0", "P1", "P2", "P3", "P4", "P5") for d, e in (("old", 1994), ("mid", 1997), ("new", None))], "station string, dataset string, ends_at int")
    return checks.dataset_owner(years, sets)
