"""Registered queries over the driver's tables and the DuckDB SQL of each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions import calendar, naming
from driftline.functions.stats import null_safe_join
from driftline.operators import comparison as cmp
from driftline.operators import features as feat
from driftline.operators import quality, screen, selection, validation
from driftline.operators.grid import area_mean
from driftline.operators.watch import Watch
from driftline.operators.windowed import cadence_of
from driftline.plans import views as v
from driftline.session import scratch, written
from driftline.sources import zones

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

STATS = list(naming.STATISTICS)
ANOM = ["mean_anom", "max_anom", "p95_anom", "variance_anom"]
MEASURED = ["mean", "max", "p95", "variance"]


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to six places, so that engines that sum in another order agree; medians of microseconds to three."""
    return df.select(*(F.round(F.col(f"`{c}`"), 3 if c == "cadence_s" else places).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes))


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: rounded(f(spark, sf_dir))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- SQL shared by the oracles -------------------------------------------------------------------

_P = ", ".join(
    "(" + ", ".join([f"'{n}'"] + ["NULL::DOUBLE" if x is None else f"{x}::DOUBLE" for x in (
        *p.get("valid_range", (None, None)), *p.get("suspect_span", (None, None)), *p.get("spike", (None, None)), *p.get("rate_per_hour", (None, None)))]) + ")"
    for n, p in v.PARAMETERS.items()
)
SQL_QC = f"""{v.SQL_OBS},
params(parameter, lo, hi, slo, shi, sp, spf, ra, raf) AS (VALUES {_P}),
s AS (
  SELECT obs.*, lag(value) OVER w AS b, lead(value) OVER w AS a, (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER w)) / 1e6 AS dt,
         count(*) OVER (PARTITION BY source, site_id, parameter, depth_m) AS n
  FROM obs WINDOW w AS (PARTITION BY source, site_id, parameter, depth_m ORDER BY timestamp, fetch_run_id)
),
t AS (
  SELECT s.*, p.lo IS NOT NULL AS known,
    CASE WHEN lo IS NULL THEN NULL WHEN value IS NULL THEN 'missing' WHEN value < lo OR value > hi THEN 'fail'
         WHEN coalesce(value < slo OR value > shi, false) THEN 'suspect' ELSE 'pass' END AS g,
    CASE WHEN sp IS NULL OR n < 3 OR (parameter = 'view' AND source = 'src1') THEN NULL WHEN value IS NULL THEN 'missing' WHEN abs(value - (b + a) / 2) IS NULL THEN NULL
         WHEN abs(value - (b + a) / 2) > spf THEN 'fail' WHEN abs(value - (b + a) / 2) > sp THEN 'suspect' ELSE 'pass' END AS k,
    CASE WHEN ra IS NULL OR n < 2 THEN NULL WHEN value IS NULL THEN 'missing' WHEN b IS NULL THEN NULL
         WHEN abs((value - b) / nullif(dt, 0)) * 3600 > raf THEN 'fail' WHEN abs((value - b) / nullif(dt, 0)) * 3600 > ra THEN 'suspect' ELSE 'pass' END AS r
  FROM s LEFT JOIN params p USING (parameter)
),
qc AS (
  SELECT timestamp, site_id, parameter, value, depth_m,
    (CASE WHEN NOT known THEN qc_flag WHEN list_contains([g, k, r], 'missing') THEN 9 WHEN list_contains([g, k, r], 'fail') THEN 4
          WHEN list_contains([g, k, r], 'suspect') THEN 3 WHEN list_contains([g, k, r], 'pass') THEN 1 ELSE 2 END)::TINYINT AS qc_flag,
    CASE WHEN known THEN concat_ws(';', 'gross_range:' || g, 'spike:' || k, 'rate_of_change:' || r) ELSE '' END AS qc_tests, source, fetch_run_id
  FROM t
)"""


def sql_reduce(rows: str, keys: list[str], features: dict, closed: bool = False, day_based: bool = True, cadence: str | None = None, floor: float = v.FLOOR) -> str:
    """CTEs that end in ``red``: the windows of ``rows`` reduced as reduce_windows does."""
    k = ", ".join(keys)
    same = lambda a, b: " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in keys)
    lab = naming.threshold_label
    cols, joins, spell_ctes, day_aggs = [], [], [], []
    for p, t in features.items():
        t = t or {}
        cols += [f"avg(CASE WHEN keep AND parameter = '{p}' THEN (value BETWEEN {a} AND {b})::INT::DOUBLE END) AS frac_in_band_{naming.band_label(a, b)}" for a, b in t.get("time_in_band", ())]
        day_aggs += [f"sum((dmax > {x})::INT::DOUBLE) FILTER (WHERE parameter = '{p}') AS days_above_{lab(x)}" for x in t.get("days_above", ())]
        day_aggs += [f"sum((dmin < {x})::INT::DOUBLE) FILTER (WHERE parameter = '{p}') AS days_below_{lab(x)}" for x in t.get("days_below", ())]
        day_aggs += [f"sum(greatest(dmean - {x}, 0.0)) FILTER (WHERE parameter = '{p}') AS degree_days_above_{lab(x)}" for x in t.get("degree_days_above", ())]
        for x in t.get("max_spell_above", ()):
            n = f"max_spell_above_{lab(x)}"
            spell_ctes.append(f"""
isl_{n} AS (SELECT *, (day - (row_number() OVER (PARTITION BY {k} ORDER BY day))::INT) AS isl FROM seen WHERE parameter = '{p}' AND dmax > {x}),
run_{n} AS (SELECT {k}, isl, count(*) AS len, arg_min(sb, day) AS sb, arg_max(sa, day) AS sa, min(day) AS d0, max(day) AS d1, min(w_start) AS w0, min(w_end) AS w1 FROM isl_{n} GROUP BY {k}, isl),
spell_{n} AS (SELECT {k}, max(len)::DOUBLE AS spell, bool_or(cut) AS cut FROM (SELECT *, max(len) OVER (PARTITION BY {k}) AS best,
  (NOT sb AND d0 - 1 >= w0) OR (NOT sa AND (d1 + 1)::TIMESTAMP < w1) AS cut FROM run_{n}) WHERE len = best GROUP BY {k})""")
            joins.append((n, p))
    med = f"any_value({cadence})" if cadence else "median(dt)"
    extra = ("".join(", " + c for c in cols))
    # the lag among kept rows only
    sql = f"""
lagged AS (SELECT r.*, CASE WHEN keep THEN (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER (PARTITION BY {k}, keep ORDER BY timestamp))) / 1e6 END AS dt FROM {rows} r),
main AS (
  SELECT {k}, count(*) FILTER (WHERE keep) AS n_obs, count(DISTINCT CASE WHEN keep THEN timestamp::DATE END) AS n_days_observed,
         CASE WHEN {med} > 0 THEN {med} END AS cadence_s, min(w_start) AS w_start, min(w_end) AS w_end, 2 AS qc_max_flag,
         avg(value) FILTER (WHERE keep) AS mean, min(value) FILTER (WHERE keep) AS min, max(value) FILTER (WHERE keep) AS max,
         quantile_cont(value, 0.05) FILTER (WHERE keep) AS p05, quantile_cont(value, 0.95) FILTER (WHERE keep) AS p95,
         CASE WHEN count(*) FILTER (WHERE keep) > 1 THEN var_samp(value) FILTER (WHERE keep) END AS variance{extra}
  FROM lagged GROUP BY {k}
),
cov AS (SELECT *, (epoch_us(w_end) - epoch_us(w_start)) / 1e6 / cadence_s{' + 1' if closed else ''} AS expected_obs FROM main),"""
    if day_based and day_aggs:
        sql += f"""
days AS (SELECT {k}, timestamp::DATE AS day, max(value) AS dmax, min(value) AS dmin, avg(value) AS dmean, min(w_start) AS w_start, min(w_end) AS w_end FROM {rows} WHERE keep GROUP BY {k}, day),
seen AS (SELECT *, coalesce(lag(day) OVER w = day - 1, false) AS sb, coalesce(lead(day) OVER w = day + 1, false) AS sa FROM days WINDOW w AS (PARTITION BY {k} ORDER BY day)),
dayagg AS (SELECT {k}, {', '.join(day_aggs)} FROM days GROUP BY {k}),""" + ",".join(spell_ctes) + ("," if spell_ctes else "")
    names = [a.rsplit(" AS ", 1)[1] for a in day_aggs]
    sel = "".join(f", dayagg.{n}" for n in names) if day_based else ""
    if day_based:
        for n, p in joins:
            sel += f", CASE WHEN c.parameter = '{p}' AND n_obs > 0 THEN coalesce(spell_{n}.spell, 0.0) END AS {n}_days, CASE WHEN c.parameter = '{p}' AND n_obs > 0 THEN coalesce(spell_{n}.cut, false) END AS {n}_gap_interrupted"
    frm = "cov c" + (f" LEFT JOIN dayagg ON {same('c', 'dayagg')}" if day_based and day_aggs else "")
    frm += "".join(f" LEFT JOIN spell_{n} ON {same('c', 'spell_' + n)}" for n, _ in joins) if day_based else ""
    sql += f"""
red AS (
  SELECT c.*, coalesce(least(n_obs / expected_obs, 1.0), 0.0) AS pct_coverage, n_obs >= 2 AND coalesce(least(n_obs / expected_obs, 1.0), 0.0) >= {floor} AS usable{sel}
  FROM {frm}
)"""
    return sql


def sql_rounded(source: str, columns: list[str], doubles: set[str], prefix: str) -> str:
    cols = ", ".join(f"round({c}, {3 if c == 'cadence_s' else 6}) AS {c}" if c in doubles else c for c in columns)
    return f"WITH {prefix} SELECT {cols} FROM {source}"


Q = feat.QUARTER
BOOK = ["n_obs", "n_days_observed", "cadence_s", "expected_obs", "pct_coverage", "usable", "qc_max_flag"]
DBL = {"cadence_s", "expected_obs", "pct_coverage", "depth_m", *STATS}


def _sql_quarterly(obs_cte: str, obs_name: str, features: dict, floor: float = v.FLOOR) -> str:
    names = ", ".join(f"'{p}'" for p in features)
    return f"""{obs_cte},
qrows AS (
  SELECT *, year(timestamp)::INT AS year, quarter(timestamp)::TINYINT AS quarter, qc_flag <= 2 AND value IS NOT NULL AS keep,
         date_trunc('quarter', timestamp)::TIMESTAMP AS w_start, (date_trunc('quarter', timestamp) + INTERVAL 3 MONTH)::TIMESTAMP AS w_end
  FROM {obs_name} WHERE parameter IN ({names})
),""" + sql_reduce("qrows", Q, features, floor=floor)


SQL_QUARTERLY = _sql_quarterly(SQL_QC, "qc", v.FEATURES)
_FEATS = [c for c, _ in naming.feature_columns(v.FEATURES)]
_FDBL = {c for c, t in naming.feature_columns(v.FEATURES) if t == "double"}


# --- observations and quality --------------------------------------------------------------------


def _evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.evaluate(written(zones.dedupe(v.obs(spark, sf_dir)), "observations"), v.PARAMETERS)


@query(f"""WITH {v.SQL_OBS} SELECT timestamp, site_id, parameter, value, depth_m, qc_flag::TINYINT AS qc_flag, '' AS qc_tests, source, fetch_run_id FROM obs
QUALIFY row_number() OVER (PARTITION BY source, site_id, parameter, timestamp, depth_m ORDER BY fetch_run_id DESC, value DESC NULLS LAST) = 1""")
def observations_deduped(spark, sf_dir):
    return zones.dedupe(v.obs(spark, sf_dir))


@query(f"WITH {SQL_QC} SELECT * FROM qc")
def qc_evaluate(spark, sf_dir):
    return _evaluated(spark, sf_dir)


@query(f"WITH {SQL_QC} SELECT * FROM qc")
def qc_evaluate_twice(spark, sf_dir):
    return quality.evaluate(_evaluated(spark, sf_dir), v.PARAMETERS)


#: What other stages recorded, by second % 5: none, a window, a stale test and a foreign one, one name twice and blanks, a window and a stale test.
_FOREIGN = ("", "deployment_window:fail", "spike:fail;station:suspect", "station:fail; station:pass ;;agency:missing", "deployment_window:pass;rate_of_change:suspect")


@query(f"""WITH {SQL_QC}, x AS (
  SELECT *, {list(_FOREIGN)}[second(timestamp) % 5 + 1] AS recorded, [NULL, 'fail', NULL, NULL, 'pass'][second(timestamp) % 5 + 1] AS w,
         [NULL, NULL, 'suspect', 'pass', NULL][second(timestamp) % 5 + 1] AS st, [NULL, NULL, NULL, 'missing', NULL][second(timestamp) % 5 + 1] AS ag FROM t
)
SELECT timestamp, site_id, parameter, value, depth_m,
  (CASE WHEN NOT known THEN qc_flag WHEN list_contains([g, k, r, w, st, ag], 'missing') THEN 9 WHEN list_contains([g, k, r, w, st, ag], 'fail') THEN 4
        WHEN list_contains([g, k, r, w, st, ag], 'suspect') THEN 3 WHEN list_contains([g, k, r, w, st, ag], 'pass') THEN 1 ELSE 2 END)::TINYINT AS qc_flag,
  CASE WHEN known THEN concat_ws(';', 'deployment_window:' || w, 'gross_range:' || g, 'spike:' || k, 'rate_of_change:' || r, 'agency:' || ag, 'station:' || st) ELSE recorded END AS qc_tests,
  source, fetch_run_id FROM x""")
def qc_evaluate_foreign(spark, sf_dir):
    recorded = F.get(F.array(*map(F.lit, _FOREIGN)), F.second("timestamp") % 5)
    obs = written(zones.dedupe(v.obs(spark, sf_dir)), "observations").withColumn("qc_tests", recorded)
    return quality.evaluate(obs, v.PARAMETERS)


@query(f"WITH {SQL_QC} SELECT source, qc_flag, count(*) AS n_rows FROM qc GROUP BY ALL")
def flag_histogram(spark, sf_dir):
    return quality.flag_histogram(_evaluated(spark, sf_dir), "source")


@query(f"""WITH {SQL_QC} SELECT source, site_id, parameter, depth_m, count(*) AS n_rows, min(timestamp) AS first_at, max(timestamp) AS last_at,
  count(*) FILTER (WHERE qc_flag = 1) AS flag_1, count(*) FILTER (WHERE qc_flag = 2) AS flag_2, count(*) FILTER (WHERE qc_flag = 3) AS flag_3,
  count(*) FILTER (WHERE qc_flag = 4) AS flag_4, count(*) FILTER (WHERE qc_flag = 9) AS flag_9 FROM qc GROUP BY ALL""")
def series_report(spark, sf_dir):
    return quality.series_report(_evaluated(spark, sf_dir))


@query(f"""WITH {SQL_QC}, p AS (SELECT source, site_id, parameter, depth_m, count(*) AS n_rows, count(*) FILTER (WHERE qc_flag = 4) AS flag_4 FROM qc WHERE parameter IN ({', '.join(repr(p) for p in v.PARAMETERS)}) GROUP BY ALL)
SELECT source, site_id, parameter, depth_m, n_rows, flag_4,
  concat_ws(',', 'gross_range', CASE WHEN parameter IN ('click', 'view', 'purchase') AND NOT (parameter = 'view' AND source = 'src1') AND NOT (parameter = 'purchase' AND source = 'src9') AND n_rows >= 3 THEN 'spike' END,
    CASE WHEN parameter IN ('click', 'view') AND n_rows >= 2 THEN 'rate_of_change' END) AS tests,
  concat_ws('; ', CASE WHEN parameter IN ('click', 'view', 'purchase') AND NOT (parameter = 'view' AND source = 'src1') AND n_rows < 3 THEN 'spike not run: fewer than three rows' END,
    CASE WHEN parameter IN ('click', 'view') AND n_rows < 2 THEN 'rate_of_change not run: fewer than two rows' END) AS notes FROM p""")
def evaluation_report(spark, sf_dir):
    return quality.evaluation_report(_evaluated(spark, sf_dir), v.PARAMETERS).select(*quality.SERIES, "n_rows", "flag_4", "tests", "notes")


@query(f"""WITH {v.SQL_OBS}, params(parameter, lo, hi, ra) AS (VALUES ('click', 0.0::DOUBLE, 250.0::DOUBLE, 30.0::DOUBLE), ('view', 0.0, 250.0, 30.0), ('purchase', 1.0, 200.0, NULL), ('error', 0.0, 300.0, NULL)),
rows_ AS (SELECT source, site_id, parameter, depth_m, timestamp FROM obs UNION ALL SELECT DISTINCT source, site_id, parameter, 100.0::DOUBLE, date_trunc('week', timestamp)::TIMESTAMP FROM obs),
g AS (SELECT source, site_id, parameter, depth_m, min(dt) FILTER (WHERE dt > 0) AS least_s FROM
  (SELECT *, (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER (PARTITION BY source, site_id, parameter, depth_m ORDER BY timestamp))) / 1e6 AS dt FROM rows_) GROUP BY ALL)
SELECT source, site_id, parameter, depth_m, round(least_s, 6) AS least_s, round((hi - lo) / least_s * 3600, 6) AS most_per_hour FROM g JOIN params USING (parameter) WHERE (hi - lo) / least_s * 3600 < ra""")
def unreachable_rates(spark, sf_dir):
    """Of all observations and of weekly means beside them, whose steps are too long for the declared rates."""
    obs = v.obs(spark, sf_dir)
    week = F.date_trunc("week", "timestamp").cast("timestamp_ntz").alias("timestamp")
    weekly = obs.groupBy("source", "site_id", "parameter", week).agg(F.avg("value").alias("value")).withColumn("depth_m", F.lit(100.0))
    return quality.unreachable_rates(obs.select(*quality.SERIES, "timestamp", "value").unionByName(weekly), v.PARAMETERS)


@query("SELECT s AS source, p AS parameter FROM (VALUES ('src1', 'view'), ('src9', 'purchase')) t(s, p) WHERE NOT EXISTS (SELECT 1 FROM events WHERE 'src' || (user_id % 2) = s AND event_type = p)")
def unmatched_exceptions(spark, sf_dir):
    return quality.unmatched_exceptions(v.obs(spark, sf_dir), v.PARAMETERS)


@query(f"WITH {v.SQL_OBS} SELECT parameter, count(*) AS n_rows FROM obs WHERE parameter NOT IN ({', '.join(repr(p) for p in v.FEATURES)}) GROUP BY 1")
def unbuilt_parameters(spark, sf_dir):
    return feat.unbuilt(v.obs(spark, sf_dir), v.FEATURES)


_ESC = lambda c: f"replace(replace(replace({c}, chr(92), chr(92) || chr(92)), '|', chr(92) || '|'), '~', chr(92) || '~')"
_HALF = lambda i: f"format('{{:016x}}', (sum(('0x' || substr(h, {i}, 16))::UBIGINT::HUGEINT) % 18446744073709551616::HUGEINT)::UBIGINT)"
_SQL_HASHED = f"""{v.SQL_OBS}, hashed AS (SELECT source, year(timestamp) AS year, md5(concat_ws('|', epoch_us(timestamp)::VARCHAR, {_ESC('site_id')}, {_ESC('parameter')}, coalesce(printf('%.9e', value), '~'), coalesce(printf('%.9e', depth_m), '~'),
qc_flag::VARCHAR, '', {_ESC('source')}, {_ESC('fetch_run_id')})) AS h FROM obs)"""


@query(f"WITH {_SQL_HASHED} SELECT count(*) AS n_rows, {_HALF(1)} || {_HALF(17)} AS digest FROM hashed")
def observations_fingerprint(spark, sf_dir):
    return zones.fingerprint(v.obs(spark, sf_dir))


@query(f"WITH {_SQL_HASHED} SELECT source, count(*) AS n_rows, {_HALF(1)} || {_HALF(17)} AS digest FROM hashed GROUP BY source")
def fingerprints_merged(spark, sf_dir):
    """By source, merged from the fingerprints of each source's sites."""
    return zones.merged_fingerprints(zones.fingerprint(v.obs(spark, sf_dir), "source", "site_id"), "source")


@query(f"""WITH {v.SQL_OBS} SELECT source, site_id, parameter FROM obs GROUP BY ALL HAVING bool_or(value > 200) ORDER BY ALL""")
def partitions_changed(spark, sf_dir):
    """Partitions that a rebuild with values beyond 200 left out changes."""
    obs = v.obs(spark, sf_dir)
    return zones.changed_partitions(obs.filter("value is null or value <= 200"), obs, "source", "site_id", "parameter")


# --- quarterly features ----------------------------------------------------------------------------


@query(f"""WITH {v.SQL_OBS}, k AS (SELECT source, site_id, parameter, depth_m, year(timestamp) AS year, quarter(timestamp)::TINYINT AS quarter, timestamp, value FROM obs WHERE value IS NOT NULL),
g AS (SELECT *, (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER (PARTITION BY source, site_id, parameter, depth_m, year, quarter ORDER BY timestamp))) / 1e6 AS dt FROM k)
SELECT source, site_id, parameter, depth_m, year, quarter, round(quantile_cont(value, 0.05), 6) AS p05, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(median(dt), 3) AS cadence_s
FROM g GROUP BY ALL""")
def quarterly_points_counted(spark, sf_dir):
    """Percentiles and cadence of every quarter, all by counting, none of a held buffer."""
    keys = feat.QUARTER
    rows = v.obs(spark, sf_dir).filter("value is not null").withColumn("year", F.year("timestamp")).withColumn("quarter", F.quarter("timestamp").cast("tinyint"))
    rows = written(rows.select(*keys, "timestamp", "value"), "kept")
    p = selection.percentiles(rows, keys, "value", [0.05, 0.5, 0.95]).select(*keys, *(F.col("points")[i].alias(n) for i, n in enumerate(("p05", "p50", "p95"))))
    return null_safe_join(p, cadence_of(rows, keys, held=0), keys)


def _quarterly(spark, sf_dir):
    return feat.build_quarterly(_evaluated(spark, sf_dir), v.FEATURES, v.FLOOR, v.NOW)


_SETS = ["feature_set", "quarter_complete", "clamped"]
_SQL_SETS = f"(SELECT *, CASE WHEN parameter = 'click' THEN 'thresholds' ELSE 'statistics' END AS feature_set, w_end <= TIMESTAMP '{v.NOW}' AS quarter_complete, coalesce(n_obs > expected_obs, false) AS clamped FROM red)"


@query(sql_rounded(_SQL_SETS, [*Q, *_SETS, *BOOK, *_FEATS], DBL | _FDBL, SQL_QUARTERLY))
def quarterly_env(spark, sf_dir):
    return _quarterly(spark, sf_dir).select(*Q, *_SETS, *BOOK, *_FEATS)


@query(f"""WITH {SQL_QUARTERLY}, w AS (
  SELECT 'rows_of_unbuilt_parameters' AS warning, count(*) AS n_rows FROM obs WHERE parameter NOT IN ({', '.join(repr(p) for p in v.FEATURES)})
  UNION ALL SELECT 'quarters_clamped', count(*) FILTER (WHERE clamped) FROM {_SQL_SETS} UNION ALL SELECT 'quarters_without_rows', count(*) FILTER (WHERE n_obs = 0) FROM {_SQL_SETS})
SELECT 'quarterly_env' AS stage, warning, n_rows, 'run-1' AS run_id FROM w WHERE n_rows > 0""")
def run_warnings(spark, sf_dir):
    """What a quarterly build left out or bent, counted while it was stored."""
    root, seen = scratch(spark, "zone"), Watch()
    built = feat.build_quarterly(_evaluated(spark, sf_dir), v.FEATURES, v.FLOOR, v.NOW, watch=seen)
    zones.replace_features(built, root, "quarterly_env", feat.QUARTER)
    zones.append_audit(seen.warnings(spark), root, "run_warnings", "run-1")
    return spark.read.schema("stage string, warning string, n_rows bigint, run_id string").parquet(f"{root}/run_warnings")


@query(f"""WITH {SQL_QUARTERLY} SELECT source, site_id, parameter, depth_m, feature_set, sum(n_obs)::BIGINT AS n_rows, count(*) AS n_quarters, count(*) FILTER (WHERE usable) AS n_usable,
min(year || 'Q' || quarter) AS first_quarter, max(year || 'Q' || quarter) AS last_quarter FROM {_SQL_SETS} GROUP BY ALL""")
def quarterly_report(spark, sf_dir):
    return feat.quarterly_report(_quarterly(spark, sf_dir))


@query(f"WITH {SQL_QUARTERLY} SELECT source, count(*) AS n_quarters, sum(n_obs)::BIGINT AS n_rows FROM red GROUP BY 1")
def union_of_builds(spark, sf_dir):
    """Of every source that occurs, and of one that does not."""
    obs = written(_evaluated(spark, sf_dir), "evaluated")
    sources = sorted(r.source for r in obs.select("source").distinct().collect())
    builds = [feat.build_quarterly(obs.filter(F.col("source") == s), v.FEATURES, v.FLOOR, v.NOW) for s in (*sources, "none")]
    return feat.union_builds(builds).groupBy("source").agg(F.count("*").alias("n_quarters"), F.sum("n_obs").alias("n_rows"))


_LFEATS = [c for c, _ in naming.feature_columns(v.LONG_FEATURES)]
SQL_QLONG = _sql_quarterly(v.SQL_LONG, "obs", v.LONG_FEATURES, 0.0) + f""",
ql AS (SELECT *, w_end <= TIMESTAMP '{v.NOW}' AS quarter_complete, CASE WHEN site_id = 'S2' THEN 1996 ELSE 1995 END AS b0, CASE WHEN site_id = 'S2' THEN 2001 ELSE 2000 END AS b1 FROM red),
base AS (SELECT * FROM ql WHERE usable AND quarter_complete AND year BETWEEN b0 AND b1),
lng AS (SELECT source, site_id, parameter, depth_m, quarter, b0, b1, year, feature, x FROM (
  {' UNION ALL '.join(f"SELECT source, site_id, parameter, depth_m, quarter, b0, b1, year, '{m}' AS feature, {m} AS x FROM base" for m in MEASURED)}) WHERE x IS NOT NULL),
clim AS (SELECT source, site_id, parameter, depth_m, quarter, b0 AS baseline_start_year, b1 AS baseline_end_year, feature, count(DISTINCT year) AS n_years,
  avg(x) AS baseline_mean, CASE WHEN count(*) > 1 THEN stddev_samp(x) END AS baseline_std FROM lng GROUP BY ALL),
wide AS (SELECT source, site_id, parameter, quarter, {', '.join(f"max(CASE WHEN feature = '{m}' AND n_years >= 3 THEN baseline_mean END) AS b_{m}" for m in MEASURED)} FROM clim GROUP BY ALL),
yrs AS (SELECT source, site_id, parameter, quarter, count(DISTINCT year) AS baseline_years FROM base GROUP BY ALL),
anom AS (SELECT ql.*, coalesce(yrs.baseline_years, 0) AS baseline_years, {', '.join(f'ql.{m} - b_{m} AS {m}_anom' for m in MEASURED)}
  FROM ql LEFT JOIN wide USING (source, site_id, parameter, quarter) LEFT JOIN yrs USING (source, site_id, parameter, quarter))"""


def _qlong(spark, sf_dir):
    return feat.build_quarterly(v.obs_long(spark, sf_dir), v.LONG_FEATURES, 0.0, v.NOW)


def _anomalies(spark, sf_dir):
    q = written(_qlong(spark, sf_dir), "quarterly")  # read for the baselines, their years and the quarters
    clim = feat.climatology(q, MEASURED, quality.SERIES, v.BASELINE, "site_id")
    return feat.with_anomalies(q, clim, MEASURED, quality.SERIES, v.BASELINE, "site_id")


@query(sql_rounded("clim", [*quality.SERIES, "quarter", "feature", "baseline_start_year", "baseline_end_year", "n_years", "baseline_mean", "baseline_std"], {"depth_m", "baseline_mean", "baseline_std"}, SQL_QLONG))
def climatology_env(spark, sf_dir):
    return feat.climatology(_qlong(spark, sf_dir), MEASURED, quality.SERIES, v.BASELINE, "site_id")


@query(sql_rounded("anom", [*Q, "n_obs", "usable", *_LFEATS, "baseline_years", *ANOM], {"depth_m", *_LFEATS, *ANOM}, SQL_QLONG))
def quarterly_anomalies(spark, sf_dir):
    return _anomalies(spark, sf_dir).select(*Q, "n_obs", "usable", *_LFEATS, "baseline_years", *ANOM)


@query(f"""WITH {SQL_QLONG} SELECT site_id, max(n) AS most_years FROM (SELECT source, site_id, parameter, depth_m, quarter, count(DISTINCT year) AS n FROM ql
WHERE usable AND quarter_complete AND year BETWEEN 1995 AND 2000 AND site_id = 'S2' GROUP BY ALL) GROUP BY 1 HAVING max(n) >= 3""")
def needless_overrides(spark, sf_dir):
    return feat.needless_overrides(_qlong(spark, sf_dir), v.BASELINE)


@query(f"""WITH {SQL_QLONG}, l AS ({' UNION ALL '.join(f"SELECT source, site_id, parameter, depth_m, '{m}' AS feature, {m} AS v FROM ql" for m in MEASURED)})
SELECT source, site_id, parameter, depth_m, feature, count(v) AS n_present, count(DISTINCT round(v, 6)) AS n_distinct,
CASE WHEN count(v) = 0 THEN 'not_applicable' WHEN count(DISTINCT round(v, 6)) < 10 THEN 'excluded' WHEN count(DISTINCT round(v, 6)) < 25 THEN 'low_resolution' ELSE 'ok' END AS verdict FROM l GROUP BY ALL""")
def resolution_audit(spark, sf_dir):
    return screen.resolution_audit(_qlong(spark, sf_dir), MEASURED)


# --- the response and the comparison ---------------------------------------------------------------

SQL_CANOPY = f"""landed AS (
  SELECT 'P' || (o_custkey % 6) AS polygon_id, year(o_orderdate)::INT AS year, quarter(o_orderdate)::TINYINT AS quarter, round(sum(o_totalprice), 2) AS area_m2,
         count(*) FILTER (WHERE o_orderstatus = 'F') AS n_cells_canopy, count(*) FILTER (WHERE o_orderstatus <> 'P') AS n_cells_observed, count(*) AS n_cells
  FROM orders GROUP BY 1, 2, 3),
cq AS (SELECT polygon_id, year, quarter, CASE WHEN n_cells_observed > 0 THEN area_m2 END AS area_m2, CASE WHEN n_cells_observed > 0 THEN n_cells_canopy END AS n_cells_canopy,
  n_cells_observed, n_cells, n_cells_observed / n_cells AS pct_coverage, n_cells_observed > 0 AND n_cells_observed / n_cells >= 0.6 AS usable,
  make_date(year, quarter * 3 - 2, 1) + INTERVAL 3 MONTH <= TIMESTAMP '{v.NOW}' AS quarter_complete FROM landed),
cb AS (SELECT polygon_id, quarter, count(DISTINCT year) AS baseline_years, count(DISTINCT CASE WHEN area_m2 IS NOT NULL THEN year END) AS n_years, avg(area_m2) AS m
  FROM cq WHERE usable AND quarter_complete AND year BETWEEN 1995 AND 2000 GROUP BY ALL),
canopy AS (SELECT cq.*, coalesce(baseline_years, 0) AS baseline_years, CASE WHEN n_years >= 3 THEN area_m2 - m END AS area_m2_anom FROM cq LEFT JOIN cb USING (polygon_id, quarter))"""


def _canopy(spark, sf_dir):
    landed = written(v.canopy_landed(spark, sf_dir), "canopy")  # read as the quarters, their baselines and years
    return feat.build_canopy(landed, 0.6, v.NOW, v.BASELINE)[0]


@query(f"WITH {SQL_CANOPY} SELECT * REPLACE (round(pct_coverage, 6) AS pct_coverage, round(area_m2_anom, 6) AS area_m2_anom) FROM canopy")
def quarterly_canopy(spark, sf_dir):
    return _canopy(spark, sf_dir)


@query(f"""WITH {SQL_CANOPY} SELECT polygon_id, count(*) AS n_quarters, count(*) FILTER (WHERE usable) AS n_usable, count(*) FILTER (WHERE n_cells_observed > 0) AS n_observed,
count(*) FILTER (WHERE n_cells_observed = 0) AS n_blind, count(*) FILTER (WHERE n_cells_observed > 0 AND NOT usable) AS n_thin,
min(year || 'Q' || quarter) AS first_quarter, max(year || 'Q' || quarter) AS last_quarter FROM canopy GROUP BY 1""")
def canopy_report(spark, sf_dir):
    return feat.canopy_report(_canopy(spark, sf_dir))


@query(f"""WITH {SQL_CANOPY}, s AS (SELECT polygon_id, area_m2 AS x FROM canopy WHERE area_m2 IS NOT NULL)
SELECT polygon_id, count(*) AS n_quarters, count(*) FILTER (WHERE x = 0) AS n_zero, count(*) FILTER (WHERE x = 0) / count(*) AS zero_share, count(DISTINCT x) AS n_distinct,
round(CASE WHEN count(*) > 2 AND max(x) > min(x) THEN skewness(x) END, 6) AS skew, count(*) FILTER (WHERE x > 0) AS n_nonzero FROM s GROUP BY 1""")
def response_shape(spark, sf_dir):
    return screen.response_shape(_canopy(spark, sf_dir))


@query(f"""WITH {SQL_CANOPY}, d AS (SELECT *, pow(area_m2 - avg(area_m2) OVER (PARTITION BY polygon_id), 2) AS d2, count(*) OVER (PARTITION BY polygon_id) AS n FROM canopy WHERE area_m2 IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY polygon_id ORDER BY d2 DESC, year, quarter) AS rn FROM d)
SELECT polygon_id, round(sum(CASE WHEN rn <= round_even(n * 0.05, 0) THEN d2 ELSE 0 END) / sum(d2), 6) AS leverage FROM r GROUP BY 1""")
def response_leverage(spark, sf_dir):
    return screen.leverage(_canopy(spark, sf_dir), "area_m2")


_PS = ", ".join(f"('{p}', '{s}')" for p, s in v.POLYGON_SITES)
SQL_COMPARISON = f"""{SQL_QLONG}, {SQL_CANOPY},
ps(polygon_id, site_id) AS (VALUES {_PS}),
pairs AS (SELECT DISTINCT source, site_id, parameter, depth_m, polygon_id FROM anom JOIN ps USING (site_id)),
gridq AS (SELECT pairs.*, c.year, c.quarter, c.usable AS canopy_usable, c.area_m2, c.area_m2_anom AS canopy_anom, lag, c.year * 4 + c.quarter - 1 - lag AS qi
  FROM pairs JOIN canopy c USING (polygon_id), (SELECT unnest([0, 1, 2, 3, 4]) AS lag)),
gridl AS (SELECT * EXCLUDE (qi), (qi // 4)::INT AS env_year, (qi % 4 + 1)::TINYINT AS env_quarter FROM gridq),
comp AS (SELECT g.*, a.usable AS env_usable, {', '.join('a.' + m for m in ANOM)} FROM gridl g LEFT JOIN anom a
  ON g.source = a.source AND g.site_id = a.site_id AND g.parameter = a.parameter AND g.depth_m IS NOT DISTINCT FROM a.depth_m AND g.env_year = a.year AND g.env_quarter = a.quarter),
gated AS (SELECT *, year * 4 + quarter - 1 AS q FROM comp WHERE canopy_usable AND coalesce(env_usable, false) AND canopy_anom IS NOT NULL)"""
_COMP = ["polygon_id", *quality.SERIES, "year", "quarter", "lag", "env_year", "env_quarter", "canopy_usable", "env_usable", "canopy_anom", *ANOM]


def _comparison(spark, sf_dir):
    return cmp.build_comparison(_canopy(spark, sf_dir), _anomalies(spark, sf_dir), v.polygon_site(spark), ANOM)


@query(sql_rounded("comp", _COMP, {"depth_m", "canopy_anom", *ANOM}, SQL_COMPARISON))
def comparison(spark, sf_dir):
    return _comparison(spark, sf_dir).select(*_COMP)


@query(f"""WITH {SQL_COMPARISON} SELECT count(*) AS n_rows, count(*) FILTER (WHERE canopy_usable) AS n_response_usable, count(*) FILTER (WHERE canopy_usable AND env_usable IS NOT NULL) AS n_predictor_present,
count(*) FILTER (WHERE canopy_usable AND env_usable) AS n_predictor_usable, (SELECT count(*) FROM gated) AS n_gated, count(*) FILTER (WHERE canopy_usable AND env_usable IS NULL) AS n_predictor_missing,
(SELECT count(*) FROM gated WHERE lag = 0) AS n_gated_lag0, (SELECT count(DISTINCT (polygon_id, year, quarter)) FROM gated) AS n_quarters_reached FROM comp""")
def attrition(spark, sf_dir):
    return cmp.attrition(_comparison(spark, sf_dir))


#: The response once more, seven years later: it goes on where the predictors have ended.
SQL_LATER = SQL_COMPARISON.replace("JOIN canopy c USING", "JOIN (SELECT * FROM canopy UNION ALL SELECT * REPLACE ((year + 7)::INT AS year) FROM canopy) c USING")


def _later_comparison(spark, sf_dir):
    canopy = written(_canopy(spark, sf_dir), "canopy")
    canopy = canopy.unionByName(canopy.withColumn("year", F.col("year") + 7))
    return cmp.build_comparison(canopy, _anomalies(spark, sf_dir), v.polygon_site(spark), ANOM)


@query(f"WITH {SQL_LATER} SELECT DISTINCT polygon_id, year, quarter FROM gated g WHERE lag > 0 AND NOT EXISTS (SELECT 1 FROM gated h WHERE h.lag = 0 AND h.polygon_id = g.polygon_id AND h.year = g.year AND h.quarter = g.quarter)")
def quarters_by_lag_only(spark, sf_dir):
    """For a response that goes on where the predictors have ended."""
    return cmp.reached_by_lag_only(_later_comparison(spark, sf_dir))


@query(f"""WITH {SQL_COMPARISON}, g AS (SELECT DISTINCT polygon_id, year, quarter, canopy_anom FROM gated)
SELECT count(*) AS n_quarters, count(*) FILTER (WHERE g.canopy_anom IS DISTINCT FROM CASE WHEN c.quarter = 2 THEN c.area_m2_anom + 1 ELSE c.area_m2_anom END) AS n_different FROM g LEFT JOIN canopy c USING (polygon_id, year, quarter)""")
def comparison_agreement(spark, sf_dir):
    """Against a response table whose second quarters were changed since."""
    later = _canopy(spark, sf_dir).withColumn("area_m2_anom", F.when(F.col("quarter") == 2, F.col("area_m2_anom") + 1).otherwise(F.col("area_m2_anom")))
    return cmp.agreement(_comparison(spark, sf_dir), later)


# --- the screen -----------------------------------------------------------------------------------

_C = "polygon_id, env_source, site_id, parameter, depth_m, lag, feature"
_R = "CASE WHEN stddev_pop({x}) * stddev_pop({y}) > 1e-12 THEN covar_pop({x}, {y}) / (stddev_pop({x}) * stddev_pop({y})) END"
SQL_SCREEN = SQL_COMPARISON + f""",
skip AS (SELECT source, site_id, parameter, feature FROM ({' UNION ALL '.join(f"SELECT source, site_id, parameter, '{m}_anom' AS feature, {m} AS v FROM ql" for m in MEASURED)}) GROUP BY ALL HAVING count(DISTINCT round(v, 6)) < 10),
cells AS (SELECT * FROM ({' UNION ALL '.join(f"SELECT polygon_id, source AS env_source, site_id, parameter, depth_m, lag, '{m}' AS feature, q, round({m}, 9) AS x, round(canopy_anom, 9) AS y FROM gated" for m in ANOM)}) WHERE x IS NOT NULL
  AND (env_source, site_id, parameter, feature) NOT IN (SELECT (source, site_id, parameter, feature) FROM skip)),
ranked AS (SELECT *, rank() OVER (PARTITION BY {_C} ORDER BY x) + (count(*) OVER (PARTITION BY {_C}, x) - 1) / 2 AS xr, rank() OVER (PARTITION BY {_C} ORDER BY y) + (count(*) OVER (PARTITION BY {_C}, y) - 1) / 2 AS yr,
  lag(q) OVER w AS qb, lag(x) OVER w AS xb, lag(y) OVER w AS yb FROM cells WINDOW w AS (PARTITION BY {_C} ORDER BY q)),
adj AS (SELECT *, CASE WHEN q - qb = 1 THEN x END AS ax, CASE WHEN q - qb = 1 THEN xb END AS axb, CASE WHEN q - qb = 1 THEN y END AS ay, CASE WHEN q - qb = 1 THEN yb END AS ayb FROM ranked),
raw AS (SELECT {_C}, count(*) AS n, {_R.format(x='x', y='y')} AS r, {_R.format(x='xr', y='yr')} AS rho,
  CASE WHEN count(ax) >= 3 THEN {_R.format(x='ax', y='axb')} END AS r1x, CASE WHEN count(ay) >= 3 THEN {_R.format(x='ay', y='ayb')} END AS r1y FROM adj GROUP BY {_C} HAVING count(*) >= 12),
scr AS (SELECT {_C}, n, round(CASE WHEN r1x * r1y IS NULL OR round(r1x * r1y, 9) <= 0 THEN n ELSE greatest(n * (1 - round(r1x * r1y, 9)) / (1 + round(r1x * r1y, 9)), 1.0) END, 1) AS n_eff,
  coalesce(round(r1x * r1y, 9) > 0, false) AS discounted, round(r, 3) + 0.0 AS r, round(rho, 3) + 0.0 AS rho, round(abs(round(r, 3) - round(rho, 3)), 3) AS rank_gap FROM raw)"""
_SIG = "polygon_id, feature, lag"
_KEYS = "env_source, site_id, parameter, depth_m"


def _cells(spark, sf_dir):
    """The cells to screen, without the (series, feature) that the audit of the same quarters excludes."""
    anom = written(_anomalies(spark, sf_dir), "anomalies")
    compared = cmp.build_comparison(_canopy(spark, sf_dir), anom, v.polygon_site(spark), ANOM)
    return screen.without_skipped(screen.long_cells(compared, ANOM), screen.resolution_audit(anom, MEASURED))


def _screen(spark, sf_dir):
    return screen.screen(_cells(spark, sf_dir))


@query(f"WITH {SQL_SCREEN} SELECT * FROM scr")
def lag_screen(spark, sf_dir):
    return _screen(spark, sf_dir)


@query(f"WITH {SQL_SCREEN} SELECT {_C}, q, count(*) AS n FROM (SELECT * FROM cells UNION ALL SELECT * FROM cells WHERE q % 5 = 0) GROUP BY ALL HAVING count(*) > 1")
def repeated_quarters(spark, sf_dir):
    """With every fifth quarter landed twice."""
    cells = _cells(spark, sf_dir)
    return screen.repeated_quarters(cells.unionByName(cells.filter("q % 5 = 0")))


@query(f"""WITH {SQL_SCREEN} SELECT * FROM scr WHERE n_eff >= 10 AND rank_gap <= 0.05 AND r IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY {_SIG} ORDER BY abs(r) DESC, {_KEYS.replace('depth_m', 'depth_m NULLS LAST')}) = 1""")
def signals(spark, sf_dir):
    return screen.signals(screen.eligible(_screen(spark, sf_dir)))


@query(f"""WITH {SQL_SCREEN}, sg AS (SELECT * FROM scr WHERE n_eff >= 10 AND rank_gap <= 0.05 AND r IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY {_SIG} ORDER BY abs(r) DESC, {_KEYS.replace('depth_m', 'depth_m NULLS LAST')}) = 1)
SELECT * FROM sg ORDER BY abs(r) DESC, polygon_id, {_KEYS.replace('depth_m', 'depth_m NULLS LAST')}, lag, feature LIMIT 3""")
def top_signals(spark, sf_dir):
    return screen.top_signals(screen.eligible(_screen(spark, sf_dir)))


@query(f"WITH {SQL_SCREEN} SELECT * FROM scr ORDER BY abs(r) DESC NULLS LAST, polygon_id, {_KEYS.replace('depth_m', 'depth_m NULLS LAST')}, lag, feature LIMIT 15")
def strongest_cells(spark, sf_dir):
    return screen.strongest(_screen(spark, sf_dir))


@query(f"WITH {SQL_SCREEN} SELECT CASE parameter WHEN 'O' THEN 'predictor' WHEN 'F' THEN 'control' END AS role, parameter, count(*) AS n_cells, max(abs(r)) AS max_abs_r, round(median(abs(r)), 6) AS median_abs_r FROM scr GROUP BY ALL")
def role_strength(spark, sf_dir):
    return screen.role_strength(screen.with_roles(_screen(spark, sf_dir), ROLES))


@query(f"WITH {SQL_SCREEN} SELECT ceiling, count(*) AS n_cells, count(DISTINCT ({_SIG})) AS n_signals FROM scr, (SELECT unnest([0.03, 0.05, 0.10, 'infinity'::DOUBLE]) AS ceiling) WHERE rank_gap <= ceiling AND n_eff >= 10 GROUP BY ALL")
def gate_ladder(spark, sf_dir):
    return screen.gate_ladder(_screen(spark, sf_dir))


ROLES = {"O": "predictor", "F": "control"}
_ROLE = "CASE parameter WHEN 'O' THEN 'predictor' WHEN 'F' THEN 'control' END"
_BY_KEY = _KEYS.replace("depth_m", "depth_m NULLS LAST")
SQL_SIGNALS = SQL_SCREEN + f""",
sig AS (SELECT *, {_ROLE} AS role FROM scr WHERE n_eff >= 10 AND rank_gap <= 0.05 AND r IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {_ROLE}, {_SIG} ORDER BY abs(r) DESC, {_BY_KEY}) = 1),
sc AS (SELECT *, abs(r) AS abs_r, CASE WHEN n_eff > 3 THEN abs(atanh(r)) * sqrt(n_eff - 3) END AS z, CASE WHEN n_eff > 3 THEN tanh(greatest(abs(atanh(r)) - 1.96 / sqrt(n_eff - 3), 0.0)) END AS bound FROM sig),
l AS (SELECT role, {_SIG}, r, n_eff, 'abs_r' AS scale, abs_r AS v FROM sc UNION ALL SELECT role, {_SIG}, r, n_eff, 'z', z FROM sc UNION ALL SELECT role, {_SIG}, r, n_eff, 'bound', bound FROM sc)"""


def _role_signals(spark, sf_dir):
    return screen.signals(screen.eligible(screen.with_roles(_screen(spark, sf_dir), ROLES)), "role")


@query(f"""WITH {SQL_SIGNALS}, k AS (SELECT *, rank() OVER (PARTITION BY scale ORDER BY v) + (count(*) OVER (PARTITION BY scale, v) - 1) / 2 AS rv, rank() OVER (PARTITION BY scale ORDER BY n_eff) + (count(*) OVER (PARTITION BY scale, n_eff) - 1) / 2 AS rn FROM l WHERE v IS NOT NULL AND role = 'predictor')
SELECT scale, count(*) AS n_signals, round({_R.format(x='rv', y='rn')}, 6) AS rho_n_eff, round(max(v), 6) AS largest FROM k GROUP BY 1""")
def scale_comparison(spark, sf_dir):
    return screen.scale_comparison(_role_signals(spark, sf_dir).filter("role = 'predictor'"))


@query(f"""WITH {SQL_SIGNALS}, top AS (SELECT * FROM sc WHERE role = 'predictor' ORDER BY abs_r DESC, polygon_id, {_BY_KEY}, lag, feature LIMIT 3),
w AS (SELECT 'abs_r' AS scale, min(abs_r) AS weakest FROM top UNION ALL SELECT 'z', min(z) FROM top UNION ALL SELECT 'bound', min(bound) FROM top)
SELECT role, scale, count(*) AS n_signals, max(n_eff) AS max_n_eff, round(max(v), 6) AS largest, round(max(weakest), 6) AS weakest, count(*) FILTER (WHERE v >= weakest) AS n_reaching FROM l JOIN w USING (scale) GROUP BY ALL""")
def scale_pools(spark, sf_dir):
    return screen.scale_pools(_role_signals(spark, sf_dir))


@query(f"""WITH {SQL_SIGNALS}, p AS (SELECT *, floor(rank() OVER (PARTITION BY role, scale ORDER BY v DESC NULLS LAST) + (count(*) OVER (PARTITION BY role, scale, v) - 1) / 2)::INT AS place0 FROM l)
SELECT role, {_SIG}, r, n_eff, scale, CASE WHEN v IS NOT NULL THEN place0 END AS place, row_number() OVER (PARTITION BY role, scale ORDER BY CASE WHEN v IS NOT NULL THEN place0 END NULLS LAST, polygon_id, feature, lag) AS nth FROM p QUALIFY nth <= 3""")
def scale_leaders(spark, sf_dir):
    return screen.scale_leaders(screen.scale_ranks(_role_signals(spark, sf_dir)))


@query(f"""WITH {SQL_SIGNALS}, b AS (SELECT max(abs(r)) FILTER (WHERE parameter = 'O') AS predictor, max(abs(r)) FILTER (WHERE parameter = 'F') AS control FROM scr WHERE n_eff >= 10 AND rank_gap <= 0.05)
SELECT *, CASE WHEN control - predictor IS NULL THEN 'not comparable' WHEN abs(control - predictor) < 0.05 THEN 'as strongly as' WHEN control > predictor THEN 'more strongly than' ELSE 'less strongly than' END AS verdict FROM b""")
def role_verdict(spark, sf_dir):
    return screen.role_verdict(screen.eligible(screen.with_roles(_screen(spark, sf_dir), ROLES)))


_TOP3 = f"SELECT {_SIG} FROM (SELECT * FROM scr WHERE n_eff >= 10 AND rank_gap <= {{c}} AND r IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {_SIG} ORDER BY abs(r) DESC, {_BY_KEY}) = 1 ORDER BY abs(r) DESC, polygon_id, {_BY_KEY}, lag, feature LIMIT 3)"


@query(f"WITH {SQL_SCREEN}, top0 AS ({_TOP3.format(c=0.05)}) " + " UNION ALL ".join(
    f"SELECT *, 'drops out' AS change, {c}::DOUBLE AS ceiling FROM (SELECT * FROM top0 EXCEPT ({_TOP3.format(c=c)})) UNION ALL SELECT *, 'enters', {c}::DOUBLE FROM (({_TOP3.format(c=c)}) EXCEPT SELECT * FROM top0)"
    for c in ("0.03", "0.05", "0.10", "'infinity'")).replace("rank_gap <= 'infinity'", "rank_gap <= 'infinity'::DOUBLE"))
def ladder_changes(spark, sf_dir):
    return screen.ladder_changes(_screen(spark, sf_dir))


@query(f"WITH {SQL_SCREEN}, t AS (SELECT * FROM scr WHERE n_eff >= 10 AND rank_gap <= 0.05 AND r IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {_SIG} ORDER BY abs(r) DESC, {_BY_KEY}) = 1) SELECT {', '.join('cells.' + c for c in _C.split(', '))}, q, round(x, 6) AS x, round(y, 6) AS y FROM cells JOIN t ON {' AND '.join(f'cells.{c} IS NOT DISTINCT FROM t.{c}' for c in _C.split(', '))}")
def signal_pairs(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    return screen.pairs_of(cells, screen.signals(screen.eligible(screen.screen(cells))))


@query(f"WITH {SQL_SCREEN} SELECT polygon_id, env_source, site_id, parameter, depth_m, feature, list_transform([0, 1, 2, 3, 4], lambda k: m[k]) AS profile FROM (SELECT polygon_id, env_source, site_id, parameter, depth_m, feature, map_from_entries(list((lag, r))) AS m FROM scr GROUP BY ALL)")
def lag_profiles(spark, sf_dir):
    return screen.lag_profiles(_screen(spark, sf_dir))


@query(f"""WITH {SQL_SCREEN} SELECT polygon_id, {_KEYS}, feature, {', '.join(f'max(r) FILTER (WHERE lag = {k}) AS "{k}"' for k in range(5))} FROM scr GROUP BY polygon_id, {_KEYS}, feature""")
def lag_feature_matrix(spark, sf_dir):
    return screen.lag_feature_matrix(_screen(spark, sf_dir))


_ACF = f"SELECT a.polygon_id, k, count(*) AS n_pairs, CASE WHEN count(*) >= 3 THEN round({_R.format(x='a.v', y='b.v')}, 6) END AS r_k FROM s a, (SELECT unnest([1, 4]) AS k), s b WHERE a.polygon_id = b.polygon_id AND a.q = b.q + k GROUP BY ALL"


@query(f"WITH {SQL_CANOPY}, s AS (SELECT polygon_id, year * 4 + quarter - 1 AS q, area_m2_anom AS v FROM canopy WHERE area_m2_anom IS NOT NULL) {_ACF}")
def response_persistence(spark, sf_dir):
    s = _canopy(spark, sf_dir).withColumn("q", calendar.quarter_index(F.col("year"), F.col("quarter")))
    return screen.autocorrelation(s, ["polygon_id"], "area_m2_anom", [1, 4])


_CELL_EQ = "a.polygon_id = b.polygon_id AND a.env_source = b.env_source AND a.site_id = b.site_id AND a.parameter = b.parameter AND a.lag = b.lag AND a.feature = b.feature"


@query(f"""WITH {SQL_SCREEN}, sz AS (SELECT {_C}, count(*) AS n, (count(*) // 4)::INT AS k_max FROM cells GROUP BY {_C}),
b AS (SELECT cells.*, n, k_max, k FROM cells JOIN sz USING (polygon_id, env_source, site_id, parameter, lag, feature), unnest(generate_series(1, k_max)) AS t(k)),
per AS (SELECT {', '.join('a.' + c for c in _C.split(', '))}, b.n, b.k_max, k, count(*) AS m, {_R.format(x='a.x', y='b.x')} * {_R.format(x='a.y', y='b.y')} AS p0 FROM cells a JOIN b ON {_CELL_EQ} AND a.q = b.q + k GROUP BY ALL),
tot AS (SELECT {_C}, n, k_max, count(CASE WHEN m >= 3 THEN p0 END) AS known, sum((1 - k / n) * CASE WHEN m >= 3 THEN p0 END) AS s FROM per GROUP BY ALL)
SELECT {_C}, n, k_max, CASE WHEN known = k_max AND 1 + 2 * s > 0 THEN round(greatest(n / (1 + 2 * s), 1.0), 6) END AS n_eff_bartlett FROM tot""")
def bartlett_sizes(spark, sf_dir):
    return screen.bartlett(_cells(spark, sf_dir))


@query(f"""WITH {SQL_SCREEN}, sz AS (SELECT {_C}, count(*) AS n, kk AS k_max FROM cells, (SELECT unnest([4, 8, 12, 16]) AS kk) GROUP BY {_C}, kk),
b AS (SELECT cells.*, n, k_max, k FROM cells JOIN sz USING (polygon_id, env_source, site_id, parameter, lag, feature), unnest(generate_series(1, k_max)) AS t(k)),
per AS (SELECT {', '.join('a.' + c for c in _C.split(', '))}, b.n, b.k_max, k, count(*) AS m, {_R.format(x='a.x', y='b.x')} * {_R.format(x='a.y', y='b.y')} AS p0 FROM cells a JOIN b ON {_CELL_EQ} AND a.q = b.q + k GROUP BY ALL),
tot AS (SELECT {_C}, n, k_max, count(CASE WHEN m >= 3 THEN p0 END) AS known, sum((1 - k / n) * CASE WHEN m >= 3 THEN p0 END) AS s FROM per GROUP BY ALL)
SELECT {_C}, n, k_max, CASE WHEN known = k_max AND 1 + 2 * s > 0 THEN round(greatest(n / (1 + 2 * s), 1.0), 6) END AS n_eff_bartlett FROM tot""")
def bartlett_sweep(spark, sf_dir):
    return screen.bartlett_sweep(_cells(spark, sf_dir))


@query(f"""WITH {SQL_LATER}, s AS (SELECT DISTINCT concat_ws('|', source, site_id, parameter, coalesce(depth_m::VARCHAR, '-')) AS a, env_year * 4 + env_quarter - 1 AS q, max((lag = 0)::INT) AS zero FROM comp WHERE coalesce(env_usable, false) AND mean_anom IS NOT NULL GROUP BY ALL),
o AS (SELECT s.a, t.a AS b, count(*) AS any_lag, count(*) FILTER (WHERE s.zero = 1 AND t.zero = 1) AS lag_0 FROM s JOIN s t ON s.q = t.q AND s.a < t.a GROUP BY ALL) SELECT * FROM o WHERE any_lag <> lag_0""")
def overlap_change(spark, sf_dir):
    """For a response that goes on where the predictors have ended."""
    return screen.overlap_change(_later_comparison(spark, sf_dir), "mean_anom")


#: The declared columns; a series beside them is refused.
_NAMES = [f"{s}|S{k}|{p}|-" for s in ("A", "N", "R") for k in range(5) for p in ("F", "O")]


@query(f"""WITH {SQL_QLONG}, s AS (SELECT year, quarter, concat_ws('|', source, site_id, parameter, coalesce(depth_m::VARCHAR, '-')) AS a, mean_anom AS x FROM anom WHERE mean_anom IS NOT NULL)
SELECT year, quarter, {', '.join(f"round(max(x) FILTER (WHERE a = '{n}'), 6) AS " + '"' + n + '"' for n in _NAMES)} FROM s GROUP BY 1, 2""")
def quarter_matrix(spark, sf_dir):
    return screen.quarter_matrix(_anomalies(spark, sf_dir), "mean_anom", _NAMES)


@query(f"""WITH {SQL_QLONG}, s AS (SELECT concat_ws('|', source, site_id, parameter, coalesce(depth_m::VARCHAR, '-')) AS a, year * 4 + quarter - 1 AS q, mean_anom AS x FROM anom WHERE mean_anom IS NOT NULL)
SELECT s.a, t.a AS b, count(*) AS n_common, CASE WHEN count(*) >= 8 THEN round({_R.format(x='s.x', y='t.x')}, 6) END AS r FROM s JOIN s t ON s.q = t.q AND s.a < t.a GROUP BY ALL""")
def redundancy_matrix(spark, sf_dir):
    return screen.redundancy(_anomalies(spark, sf_dir), "mean_anom")


@query(f"""WITH {SQL_QLONG}, s AS (SELECT site_id, parameter, year * 4 + quarter - 1 AS q, avg(mean_anom) AS x FROM anom WHERE mean_anom IS NOT NULL GROUP BY ALL),
f AS (SELECT site_id, q, count(*) = max(np) AS complete FROM s JOIN (SELECT site_id, count(DISTINCT parameter) AS np FROM s GROUP BY 1) USING (site_id) GROUP BY ALL),
j AS (SELECT s.site_id, s.parameter AS a, t.parameter AS b, s.x, t.x AS y, CASE WHEN complete THEN s.x END AS cx, CASE WHEN complete THEN t.x END AS cy, complete FROM s JOIN s t ON s.site_id = t.site_id AND s.q = t.q AND s.parameter < t.parameter JOIN f ON f.site_id = s.site_id AND f.q = s.q)
SELECT site_id, a, b, count(*) AS n_pairwise, round({_R.format(x='x', y='y')}, 6) AS r_pairwise, count(*) FILTER (WHERE complete) AS n_listwise, round({_R.format(x='cx', y='cy')}, 6) AS r_listwise FROM j GROUP BY ALL""")
def remeasurement_matrix(spark, sf_dir):
    return screen.remeasurement(_anomalies(spark, sf_dir), "mean_anom")


# --- deployments and validation ---------------------------------------------------------------------

_DEP = ", ".join(
    f"('S{s}', 'T{s}', 1::BIGINT, '{p}', {'NULL' if d is None else d}::DOUBLE, TIMESTAMP '2024-01-{a:02d} 06:30:00', TIMESTAMP '2024-01-{b:02d} 18:15:00')"
    for s, a, b in ((1, 3, 12), (4, 5, 25), (7, 2, 28)) for p, d in (("click", 0.0), ("click", 5.0), ("view", 10.0), ("error", None))
)
SQL_DEP = f"""{SQL_QC},
dep(site_id, serial, deployment_number, parameter, depth_m, w_start, w_end) AS (VALUES {_DEP}),
drows AS (SELECT qc.*, serial, deployment_number, w_start, w_end, qc_flag <= 2 AND value IS NOT NULL AS keep FROM qc JOIN dep ON qc.site_id = dep.site_id AND qc.parameter = dep.parameter
  AND qc.depth_m IS NOT DISTINCT FROM dep.depth_m AND timestamp BETWEEN w_start AND w_end)"""
D = feat.DEPLOYMENT
_DSTAT = ["n_obs", "n_days_observed", "cadence_s", "expected_obs", "pct_coverage", "usable"]


def _of_deployments(spark, sf_dir):
    """Evaluated observations of the series that have a deployment; a test's window is one series, so no verdict changes."""
    return quality.evaluate(zones.dedupe(feat.of_series(v.obs(spark, sf_dir), v.deployments(spark))), v.PARAMETERS)


def _deployment(spark, sf_dir):
    return feat.build_deployment(_of_deployments(spark, sf_dir), v.deployments(spark), v.FEATURES, v.FLOOR, v.NOW)


_SQL_DONE = f"(SELECT *, w_end <= TIMESTAMP '{v.NOW}' AS deployment_complete FROM red WHERE n_obs > 0)"


@query(f"WITH {SQL_DEP}," + sql_reduce("drows", D, v.FEATURES, closed=True) + f" SELECT count(*) AS n_with_rows, count(*) FILTER (WHERE deployment_complete) AS n_complete, count(*) FILTER (WHERE usable) AS n_usable FROM {_SQL_DONE}")
def deployment_attrition(spark, sf_dir):
    return feat.deployment_attrition(_deployment(spark, sf_dir))


@query(sql_rounded(_SQL_DONE, [*D, "qc_max_flag", "deployment_complete", *_DSTAT, *_FEATS], DBL | _FDBL, SQL_DEP + "," + sql_reduce("drows", D, v.FEATURES, closed=True)))
def deployment(spark, sf_dir):
    return _deployment(spark, sf_dir).select(*D, "qc_max_flag", "deployment_complete", *_DSTAT, *_FEATS)


def _sql_sub(grain: str) -> str:
    return f"""{SQL_DEP},
kd AS (SELECT *, (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER (PARTITION BY {', '.join(D)} ORDER BY timestamp))) / 1e6 AS gap FROM drows WHERE keep),
cad AS (SELECT {', '.join(D)}, CASE WHEN median(gap) > 0 THEN median(gap) END AS cad FROM kd GROUP BY ALL),
span AS (SELECT kd.* EXCLUDE (w_start, w_end, gap), cad, date_trunc('{grain}', timestamp)::TIMESTAMP AS {grain}, greatest(date_trunc('{grain}', timestamp)::TIMESTAMP, w_start) AS w_start,
  least(date_trunc('{grain}', timestamp)::TIMESTAMP + INTERVAL 1 {grain}, w_end) AS w_end, w_start > date_trunc('{grain}', timestamp)::TIMESTAMP OR w_end < date_trunc('{grain}', timestamp)::TIMESTAMP + INTERVAL 1 {grain} AS partial,
  w_end < date_trunc('{grain}', timestamp)::TIMESTAMP + INTERVAL 1 {grain} AS is_last FROM kd JOIN cad ON {' AND '.join(f'kd.{c} IS NOT DISTINCT FROM cad.{c}' for c in D)}),
""" + sql_reduce("span", [*D, grain, "partial", "is_last"], v.FEATURES, day_based=False, cadence="cad") + f""",
sub AS (SELECT * EXCLUDE (expected_obs, pct_coverage, usable), partial AS partial_{grain}, expected_obs + is_last::INT AS expected_obs, coalesce(least(n_obs / (expected_obs + is_last::INT), 1.0), 0.0) AS pct_coverage,
  n_obs >= 2 AND coalesce(least(n_obs / (expected_obs + is_last::INT), 1.0), 0.0) >= {v.FLOOR} AS usable FROM red)"""


def _sub(spark, sf_dir, grain):
    return feat.build_sub_windows(_of_deployments(spark, sf_dir), v.deployments(spark), v.FEATURES, v.FLOOR, grain)


_SUB = ["n_obs", "cadence_s", "expected_obs", "pct_coverage", "usable", *STATS, "frac_in_band_10c_60c"]


@query(sql_rounded("sub", [*D, "day", "partial_day", *_SUB], DBL | {"frac_in_band_10c_60c"}, _sql_sub("day")))
def deployment_daily(spark, sf_dir):
    return _sub(spark, sf_dir, "day").select(*D, "day", "partial_day", *_SUB)


@query(sql_rounded("sub", [*D, "hour", "partial_hour", *_SUB], DBL | {"frac_in_band_10c_60c"}, _sql_sub("hour")))
def deployment_hourly(spark, sf_dir):
    return _sub(spark, sf_dir, "hour").select(*D, "hour", "partial_hour", *_SUB)


_AUDIT = {k: v.FEATURES["click"][k] for k in ("days_above", "days_below", "degree_days_above")}
_AUDITED = {"days_above_100c": "(max > 100.0)::INT::DOUBLE", "days_above_150c": "(max > 150.0)::INT::DOUBLE", "days_below_10c": "(min < 10.0)::INT::DOUBLE", "degree_days_above_45c": "greatest(mean - 45.0, 0.0)"}


@query(f"""WITH a AS (WITH {SQL_DEP}, {sql_reduce("drows", D, v.FEATURES, closed=True)} SELECT * FROM red WHERE n_obs > 0),
f AS (WITH {_sql_sub('day')} SELECT {', '.join(D)}, sum(n_obs)::BIGINT AS fine_n_obs, sum(expected_obs) AS fine_expected, sum(mean * n_obs) / sum(n_obs) AS fine_mean, count(*) AS n_spans, {', '.join(f'sum({e}) AS fine_{n}' for n, e in _AUDITED.items())} FROM sub GROUP BY ALL)
SELECT {', '.join('a.' + c for c in D)}, n_obs, n_days_observed, round(expected_obs, 6) AS expected_obs, round(mean, 6) AS mean, {', '.join(f'round({n}, 6) AS {n}' for n in _AUDITED)}, fine_n_obs, round(fine_expected, 6) AS fine_expected, round(fine_mean, 6) AS fine_mean, n_spans, {', '.join(f'round(fine_{n}, 6) AS fine_{n}' for n in _AUDITED)},
n_obs = fine_n_obs AND n_days_observed = n_spans AS counts_agree, abs(mean - fine_mean) <= 1e-9 * greatest(1.0, abs(mean)) AS means_agree, {' AND '.join(f'({n} IS NULL OR abs({n} - fine_{n}) <= 1e-9 * greatest(1.0, abs({n})))' for n in _AUDITED)} AS thresholds_agree, abs(expected_obs - fine_expected) <= 1e-9 * greatest(1.0, abs(expected_obs)) AS expected_agrees
FROM a LEFT JOIN f ON {' AND '.join(f'a.{c} IS NOT DISTINCT FROM f.{c}' for c in D)}""")
def deployment_grain_audit(spark, sf_dir):
    return validation.grain_audit(_deployment(spark, sf_dir), _sub(spark, sf_dir, "day"), _AUDIT)


@query(f"""WITH {_sql_sub('day')} SELECT {', '.join(D)}, day, round(sum(greatest(mean - 45.0, 0.0)) OVER (PARTITION BY {', '.join(D)} ORDER BY day), 6) AS degree_days, round(max - min, 6) AS daily_range FROM sub""")
def cumulative_degree_days(spark, sf_dir):
    return validation.cumulative_degree_days(_sub(spark, sf_dir, "day"), 45.0)


@query(f"WITH {_sql_sub('hour')} SELECT site_id, depth_m, count(frac_in_band_10c_60c) AS n_hours, round(avg(frac_in_band_10c_60c), 6) AS share FROM sub GROUP BY ALL")
def band_occupancy(spark, sf_dir):
    return validation.band_occupancy(_sub(spark, sf_dir, "hour"), "frac_in_band_10c_60c")


_P2 = [*D, "ref", "ref_depth_m"]
_SAME = lambda a, b, ks: " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in ks)


SQL_VALIDATION = f"""{SQL_DEP},
refs(site_id, ref, collapsed_refs) AS (VALUES ('S1', 'S2', 'S3'), ('S4', 'S5', ''), ('S7', 'S8', ''), ('S7', 'S2', 'S3')),
own AS (SELECT * FROM drows WHERE keep AND depth_m IS NOT NULL),
ref AS (SELECT site_id AS ref, parameter, depth_m AS ref_depth_m, timestamp, value, source FROM qc WHERE qc_flag <= 2 AND value IS NOT NULL AND site_id IN (SELECT ref FROM refs)),
ca AS (SELECT {', '.join(D)}, w_start, w_end, arg_min(source, (timestamp, source)) AS source, CASE WHEN median(g) > 0 THEN median(g) END AS ca FROM (SELECT *, (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER (PARTITION BY {', '.join(D)} ORDER BY timestamp))) / 1e6 AS g FROM own) GROUP BY ALL),
cb AS (SELECT ref, parameter, ref_depth_m, arg_min(source, (timestamp, source)) AS reference_source, CASE WHEN median(g) > 0 THEN median(g) END AS cb FROM (SELECT *, (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER (PARTITION BY ref, parameter, ref_depth_m ORDER BY timestamp))) / 1e6 AS g FROM ref) GROUP BY ALL),
pr AS (SELECT ca.*, ref, ref_depth_m, reference_source, collapsed_refs, coalesce(greatest(ca, cb), 1.0) AS cadence_s FROM ca JOIN refs USING (site_id) JOIN cb USING (ref, parameter)),
x AS (SELECT {', '.join('pr.' + c for c in _P2)}, floor(epoch_us(timestamp) / (cadence_s * 1e6)) AS bin, avg(value) AS x FROM own JOIN pr ON {_SAME('own', 'pr', D)} GROUP BY {', '.join('pr.' + c for c in _P2)}, 7),
y AS (SELECT {', '.join('pr.' + c for c in _P2)}, floor(epoch_us(timestamp) / (cadence_s * 1e6)) AS bin, avg(value) AS y FROM ref JOIN pr ON {_SAME('ref', 'pr', ['ref', 'parameter', 'ref_depth_m'])} GROUP BY {', '.join('pr.' + c for c in _P2)}, bin),
b AS (SELECT x.*, y.y FROM x JOIN y ON {_SAME('x', 'y', [*_P2, 'bin'])}),
g AS (SELECT {', '.join(_P2)}, count(*) AS n_pairs, min(bin) AS b0, max(bin) AS b1, {_R.format(x='x', y='y')} AS r, avg(x - y) AS bias, sqrt(avg(pow(x - y, 2))) AS rmse FROM b GROUP BY ALL),
val AS (SELECT {', '.join('pr.' + c for c in _P2)}, source, reference_source, collapsed_refs, abs(pr.depth_m - pr.ref_depth_m) AS depth_gap_m, coalesce(abs(pr.depth_m - pr.ref_depth_m) <= 2.0, false) AS depth_comparable, round(cadence_s, 3) AS cadence_s, coalesce(n_pairs, 0) AS n_pairs,
make_timestamp(round(b0 * cadence_s * 1e6)::BIGINT) AS overlap_start, make_timestamp(round(b1 * cadence_s * 1e6)::BIGINT) AS overlap_end,
round(CASE WHEN n_pairs >= 3 THEN r END, 6) AS correlation, CASE WHEN abs(pr.depth_m - pr.ref_depth_m) <= 2.0 THEN round(bias, 6) END AS bias, CASE WHEN abs(pr.depth_m - pr.ref_depth_m) <= 2.0 THEN round(rmse, 6) END AS rmse, 2 AS qc_max_flag
FROM pr LEFT JOIN g ON {_SAME('g', 'pr', _P2)})""".replace("_P2)}, 7)", "bin)").replace(", 7),", ", bin),")


def _validation(spark, sf_dir):
    refs = spark.createDataFrame([("S1", 1, "S2"), ("S1", 2, "S3"), ("S4", 1, "S5"), ("S7", 1, "S8"), ("S7", 2, "S3"), ("S7", 0, "S2")], "site_id string, ordinal long, ref string")
    kin = spark.createDataFrame([("S2", "S3")], "a string, b string")
    deployments = v.deployments(spark)
    sites = deployments.select("site_id").union(refs.select("ref")).distinct()
    raw = v.obs(spark, sf_dir).join(F.broadcast(sites), "site_id", "left_semi")  # a dimension of sites
    obs = written(quality.evaluate(zones.dedupe(raw), v.PARAMETERS), "evaluated")  # six parts of the plan read it
    kept = obs.filter("qc_flag <= 2 and value is not null").select(F.col("site_id").alias("ref"), "parameter")
    chosen = validation.choose_references(validation.fold_platforms(refs, kin), kept)
    return validation.build_validation(obs, deployments, chosen, 2.0)


@query(f"WITH {SQL_VALIDATION} SELECT * FROM val")
def validation_agreement(spark, sf_dir):
    return _validation(spark, sf_dir)


@query(f"""WITH a AS (WITH {SQL_DEP}, {sql_reduce("drows", D, v.FEATURES, closed=True)} SELECT * FROM red WHERE n_obs > 0 AND usable), w AS (WITH {SQL_VALIDATION} SELECT * EXCLUDE (source, qc_max_flag) FROM val)
SELECT {', '.join('a.' + c for c in D)}, a.n_obs, round(a.mean, 6) AS mean, w.* EXCLUDE ({', '.join(D)}) FROM a LEFT JOIN w ON {_SAME('a', 'w', D)}""")
def deployment_validation(spark, sf_dir):
    return validation.with_validation(_deployment(spark, sf_dir), _validation(spark, sf_dir))


@query(f"""WITH a AS (WITH {SQL_DEP}, {sql_reduce("drows", D, v.FEATURES, closed=True)} SELECT * FROM red WHERE n_obs > 0 AND usable), f AS (WITH {_sql_sub('day')} SELECT * FROM sub),
k AS (SELECT f.* FROM f WHERE EXISTS (SELECT 1 FROM a WHERE {_SAME('a', 'f', D)}) AND depth_m IS NOT NULL)
SELECT site_id, depth_m, printf('%s at %.2f m', site_id, depth_m) AS label, dense_rank() OVER (PARTITION BY site_id ORDER BY depth_m)::INT AS place, day, round(mean, 6) AS mean FROM k""")
def usable_days_by_depth(spark, sf_dir):
    kept = validation.of_usable(_sub(spark, sf_dir, "day"), _deployment(spark, sf_dir))
    return validation.depth_groups(kept, "day")


# --- grids ----------------------------------------------------------------------------------------


@query("""WITH r AS (SELECT l_shipdate AS day, (l_partkey % 10)::DOUBLE AS latitude, (l_suppkey % 10)::DOUBLE AS longitude, CASE WHEN l_linenumber <> 3 THEN l_quantity::DOUBLE END AS value FROM lineitem)
SELECT day, round(sum(value * w) / sum(CASE WHEN value IS NOT NULL THEN w END), 6) AS value, round(coalesce(sum(CASE WHEN value IS NOT NULL THEN w END), 0.0) / sum(w), 6) AS covered
FROM (SELECT *, 1.0::DOUBLE + latitude * 0.5 + longitude * 0.25 AS w FROM r WHERE latitude < 7) GROUP BY 1""")
def grid_area_mean(spark, sf_dir):
    rows = v.read(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("day"), (F.col("l_partkey") % 10).cast("double").alias("latitude"), (F.col("l_suppkey") % 10).cast("double").alias("longitude"),
        F.when(F.col("l_linenumber") != 3, F.col("l_quantity").cast("double")).alias("value"),
    )
    weights = spark.createDataFrame([(float(a), float(o), 1 + a * 0.5 + o * 0.25) for a in range(7) for o in range(10)], "latitude double, longitude double, weight double")
    return area_mean(rows, weights, ["day"])
