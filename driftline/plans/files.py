"""More registered queries: fields, logger files, shore archives and registries, read from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.functions import calendar, fields, stats, verdicts
from driftline.operators import checks, features
from driftline.plans import registry as reg
from driftline.plans import views as v
from driftline.plans.registry import ORACLES, QUERIES, SQL_SCREEN, query
from driftline.plans.reports import SQL_LOGGER, _logger
from driftline.sources import text, zones

__all__ = ["ORACLES", "QUERIES"]

ZONE = "America/Los_Angeles"


def _events(spark, sf_dir):
    return v.read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _pick(key, *choices):
    """One of ``choices`` by the remainder of ``key``."""
    return F.get(F.array(*map(F.lit, choices)), (F.col(key) % len(choices)).cast("int"))


def _sql_pick(key: str, *choices: str) -> str:
    return f"[{', '.join(repr(c) for c in choices)}][({key} % {len(choices)})::INT + 1]"


# --- fields ---------------------------------------------------------------------------------------

_UNITS = (" deg_F ", "degC", "Fahrenheit", "furlong")


@query(f"""WITH e AS (SELECT event_id, value, {_sql_pick('event_id', *_UNITS)} AS header FROM events)
SELECT event_id, header, round(CASE header WHEN 'degC' THEN value WHEN 'furlong' THEN NULL ELSE (value - 32) * 5 / 9 END, 6) AS celsius, header = 'furlong' AS refused FROM e""")
def units_converted(spark, sf_dir):
    e = v.read(spark, sf_dir, "events").withColumn("header", _pick("event_id", *_UNITS))
    return e.select("event_id", "header", fields.convert(F.col("value"), F.col("header"), "degC").alias("celsius"), fields.unit_refused(F.col("header"), "degC").alias("refused"))


@query("""WITH e AS (SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'MM' WHEN 1 THEN '999.0' WHEN 2 THEN 'n/a' WHEN 3 THEN '-7.768' ELSE event_id::VARCHAR END AS cell FROM events)
SELECT event_id, CASE WHEN event_id % 7 > 3 AND event_id <> 999 THEN event_id::DOUBLE WHEN event_id % 7 = 3 THEN -7.768::DOUBLE END AS reading,
CASE WHEN event_id % 7 = 1 THEN 999.0::DOUBLE WHEN event_id % 7 > 3 THEN event_id::DOUBLE END AS filled, event_id % 7 = 2 AS unreadable FROM e""")
def numbers_read(spark, sf_dir):
    k = F.col("event_id") % 7
    cell = F.when(k == 0, "MM").when(k == 1, "999.0").when(k == 2, "n/a").when(k == 3, "-7.768").otherwise(F.col("event_id").cast("string"))
    e = v.read(spark, sf_dir, "events").select("event_id", cell.alias("cell"))
    c = F.col("cell")
    return e.select("event_id", fields.number(c, 999.0).alias("reading"), fields.number(c, -7.768).alias("filled"), fields.unreadable(c).alias("unreadable"))


@query("""SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN date_trunc('minute', ts)::TIMESTAMP END AS stamp,
CASE WHEN event_id % 9 = 0 THEN 10 * 60 + 38 ELSE hour(ts) * 60 + minute(ts) END::INT AS clock_minute FROM events""")
def clocks_read(spark, sf_dir):
    e = _events(spark, sf_dir)
    month = F.when(F.col("event_id") % 11 == 0, "13").otherwise(F.month("ts").cast("string"))
    part = [f("ts").cast("string") for f in (F.year, F.dayofmonth, F.hour, F.minute)]
    hhmm = F.when(F.col("event_id") % 9 != 0, F.hour("ts") * 100 + F.minute("ts"))
    return e.select("event_id", fields.five_column_time(part[0], month, *part[1:]).alias("stamp"), calendar.clock(hhmm).alias("clock_minute"))


@query("""SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN hour(ts) * 3600 + minute(ts) * 60 + second(ts) END::DOUBLE AS seconds, event_type AS name, 'SN' || user_id AS serial, event_id::VARCHAR AS readout FROM events""")
def intervals_and_names(spark, sf_dir):
    e = _events(spark, sf_dir)
    said = F.when(F.col("event_id") % 13 == 0, "none").otherwise(
        F.concat_ws(" ", F.hour("ts"), F.lit("hour"), F.minute("ts"), F.lit("minutes"), F.second("ts"), F.lit("seconds"))
    )
    name, serial, readout = fields.file_parts(F.concat("event_type", F.lit("__SN"), "user_id", F.lit("__"), "event_id", F.lit(".csv")))
    return e.select("event_id", fields.interval_seconds(said).cast("double").alias("seconds"), name.alias("name"), serial.alias("serial"), readout.alias("readout"))


@query("""SELECT event_id, abs(value) AS depth_m, (CASE WHEN event_id % 97 = 0 THEN 9 ELSE 2 END)::TINYINT AS qc_flag FROM events""")
def depths_and_flags(spark, sf_dir):
    reading = F.when(F.col("event_id") % 97 != 0, F.col("value"))
    return v.read(spark, sf_dir, "events").select("event_id", fields.depth_of_altitude(-F.abs("value")).alias("depth_m"), verdicts.ingest_flag(reading).alias("qc_flag"))


# --- verdicts -------------------------------------------------------------------------------------

# the provider's tests as they are written: those of the engine in their order, the others by name
_WRITTEN = [(4, "gross_range"), (6, "spike"), (7, "rate_of_change"), (10, "attenuated_signal"), (5, "climatology"), (8, "flat_line"), (1, "gap"), (3, "location"), (9, "multi_variate"), (11, "neighbor"), (2, "syntax")]
_DIGITS = """e AS (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN '12' ELSE translate(lpad(event_id::VARCHAR, 11, '0'), '05678', '12349') END AS digits FROM events),
s AS (SELECT *, CASE WHEN length(digits) = 11 THEN digits ELSE '' END AS d FROM e)"""
_NAMED = "CASE substr(d, {i}, 1) WHEN '1' THEN '{n}:pass' WHEN '3' THEN '{n}:suspect' WHEN '4' THEN '{n}:fail' WHEN '9' THEN '{n}:missing' END"
_PROVIDER = f"""{_DIGITS}, p AS (SELECT event_id, concat_ws(';', {', '.join(_NAMED.format(i=i, n=n) for i, n in _WRITTEN)}) AS qc_tests,
(CASE WHEN contains(d, '9') THEN 9 WHEN contains(d, '4') THEN 4 WHEN contains(d, '3') THEN 3 WHEN contains(d, '1') THEN 1 ELSE 2 END)::TINYINT AS qc_flag FROM s)"""


def _provider(spark, sf_dir):
    written = F.translate(F.lpad(F.col("event_id").cast("string"), 11, "0"), "05678", "12349")
    digits = F.when(F.col("event_id") % 10 == 0, "12").otherwise(written)
    tests = verdicts.decode_digits(digits, text.PROVIDER_TESTS)
    return v.read(spark, sf_dir, "events").select("event_id", verdicts.describe(tests).alias("qc_tests"), verdicts.rollup(F.map_values(tests)).alias("qc_flag"))


@query(f"WITH {_PROVIDER} SELECT event_id, qc_tests, qc_flag FROM p")
def provider_verdicts(spark, sf_dir):
    return _provider(spark, sf_dir)


_STATUSES = ("pass", "fail", "odd", "suspect", "missing")


@query(f"""WITH e AS (SELECT event_id, {_sql_pick('event_id', *_STATUSES)} AS a, {_sql_pick('user_id', *_STATUSES)} AS b, event_id % 7 = 0 AS blank FROM events)
SELECT event_id, (CASE WHEN blank THEN 0 ELSE 2 END)::INT AS n_tests, NOT blank AND (a = 'odd' OR b = 'odd') AS malformed, CASE WHEN NOT blank THEN b END AS spike FROM e""")
def packed_verdicts(spark, sf_dir):
    packed = F.concat(F.lit("gross_range:"), _pick("event_id", *_STATUSES), F.lit(";spike:"), _pick("user_id", *_STATUSES))
    e = v.read(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 7 == 0, "").otherwise(packed).alias("qc_tests"))
    m = verdicts.parse(F.col("qc_tests"))
    return e.select("event_id", F.size(m).alias("n_tests"), verdicts.malformed(F.col("qc_tests")).alias("malformed"), F.try_element_at(m, F.lit("spike")).alias("spike"))


@query("""SELECT event_id, CASE WHEN event_id % 7 = 6 THEN NULL WHEN event_id % 7 = 0 THEN 'pass' WHEN event_id % 7 = 5 THEN 'fail' ELSE 'suspect' END AS status FROM events""")
def source_codes(spark, sf_dir):
    code = F.when(F.col("event_id") % 7 < 6, F.col("event_id") % 7)
    return v.read(spark, sf_dir, "events").select("event_id", verdicts.source_code_status(code).alias("status"))


@query("SELECT source AS file, parameter, count(*) AS n_rows, count(*) FILTER (WHERE value IS NULL) AS n_missing FROM obs GROUP BY ALL".replace("SELECT", f"WITH {v.SQL_OBS} SELECT", 1))
def rows_and_missing(spark, sf_dir):
    return zones.counts(v.obs(spark, sf_dir).withColumnRenamed("source", "file"))


@query(f"""WITH {SQL_SCREEN} SELECT polygon_id, {reg._KEYS}, lag, feature, CASE WHEN r * rho < 0 THEN 'sign differs' WHEN abs(r) > abs(rho) THEN 'Pearson larger' WHEN abs(r) < abs(rho) THEN 'Spearman larger' ELSE 'equal' END AS disagreement FROM scr""")
def disagreements(spark, sf_dir):
    cells = reg._screen(spark, sf_dir)
    return cells.select("polygon_id", *reg._KEYS.split(", "), "lag", "feature", stats.disagreement(F.col("r"), F.col("rho")).alias("disagreement"))


# --- logger files ---------------------------------------------------------------------------------

_COUNTER = """c AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS want FROM orders),
signs AS (SELECT o_custkey::VARCHAR AS file, concat_ws(',', CASE WHEN any_value(x.c_custkey) IS NOT NULL THEN 'extra columns' END, CASE WHEN count(*) FILTER (WHERE o_orderkey % 40 = 0) > 0 THEN 'rows without time' END,
CASE WHEN count(*) FILTER (WHERE o_orderkey % 50 = 0) > 0 THEN 'broken counter' END) AS signs FROM c LEFT JOIN (SELECT c_custkey FROM customer WHERE c_custkey % 20 = 0) x ON x.c_custkey = o_custkey GROUP BY 1)"""


def _edited(spark, sf_dir):
    """Logger files from ``orders``: one for each customer, whose counter and times break by a rule."""
    rows = v.read(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("file"), F.col("o_orderkey").alias("line_no"), F.when(F.col("o_orderkey") % 40 != 0, F.col("o_orderdate")).alias("timestamp_local")
    )
    counter = F.row_number().over(checks.W.partitionBy("file").orderBy("line_no")) + F.when(F.col("line_no") % 50 == 0, 1).otherwise(0)
    extra = v.read(spark, sf_dir, "customer").filter("c_custkey % 20 = 0").select(F.col("c_custkey").cast("string").alias("file"), F.lit(1).alias("n_extra"))
    return checks.edited_file(rows.withColumn("row_number", counter), extra)


@query(f"WITH {_COUNTER} SELECT file, signs FROM signs")
def edited_files(spark, sf_dir):
    return _edited(spark, sf_dir).select("file", F.array_join("signs", ",").alias("signs"))


_SERIALS = "sn AS (SELECT c_custkey::VARCHAR AS file, CASE WHEN c_custkey % 9 = 0 THEN 'none' ELSE 'SN' || c_nationkey END AS recorded, CASE WHEN c_custkey % 9 <> 0 THEN 'pass' ELSE 'warn' END AS status FROM customer)"


def _serials(spark, sf_dir):
    return checks.serials(v.read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("file"), F.concat(F.lit("SN"), "c_nationkey").alias("file_serial"),
        F.when(F.col("c_custkey") % 9 == 0, "none").otherwise(F.concat(F.lit("SN"), "c_nationkey")).alias("recorded_serial"),
    ))


@query(f"""WITH {_SERIALS} SELECT file, 'serial' AS "check", status, recorded AS detail FROM sn""")
def serial_checks(spark, sf_dir):
    return _serials(spark, sf_dir)


# logger files from ``customer``: serials of 50, of which 30 have a whole deployment, 10 one in part; maps of both series, one or none
_GATES = """cu AS (SELECT c_custkey AS k, c_custkey::VARCHAR AS file, c_custkey % 50 AS p FROM customer),
gate AS (SELECT file, 'registry gate' AS "check", CASE WHEN p < 30 THEN 'pass' ELSE 'fail' END AS status, 'SN' || p AS detail FROM cu),
map AS (SELECT file, 'series map' AS "check", CASE p % 5 WHEN 0 THEN 'fail' WHEN 1 THEN 'warn' ELSE 'pass' END AS status, CASE p % 5 WHEN 0 THEN '0/2' WHEN 1 THEN '1/2' ELSE '2/2' END AS detail FROM cu),
sp AS (SELECT k, file, CASE k % 4 WHEN 0 THEN 'PST' WHEN 1 THEN 'PDT' WHEN 2 THEN 'XST' END AS token, CASE k % 11 WHEN 0 THEN NULL WHEN 1 THEN 'Nowhere/City' ELSE '{zone}' END AS zone,
  TIMESTAMP '2024-01-05 12:00:00' + to_days((k % 300)::INT) AS a, TIMESTAMP '2024-01-25 12:00:00' + to_days((k % 300)::INT) AS b FROM cu),
hr AS (SELECT *, epoch(a - timezone('UTC', timezone('{zone}', a))) / 3600 AS ha, epoch(b - timezone('UTC', timezone('{zone}', b))) / 3600 AS hb FROM sp),
zone AS (SELECT file, 'time zone' AS "check", CASE WHEN token IS NULL THEN 'warn' WHEN zone IS NULL THEN 'skipped' WHEN zone = 'Nowhere/City' THEN 'warn' WHEN ha <> hb THEN 'warn'
  WHEN ha = -8 AND token = 'PST' OR ha = -7 AND token = 'PDT' THEN 'pass' ELSE 'warn' END AS status, token AS detail FROM hr)""".replace("{zone}", ZONE)


def _gates(spark, sf_dir):
    k = F.col("c_custkey")
    cu = v.read(spark, sf_dir, "customer").select(k.alias("k"), k.cast("string").alias("file"), (k % 50).alias("p"))
    serial = F.concat(F.lit("SN"), "p").alias("serial")
    one = F.lit("2024-01-01").cast("timestamp_ntz")
    deployed = cu.filter("p < 40").select(serial, F.lit(1).cast("long").alias("deployment_number"), one.alias("w_start"), F.when(F.col("p") < 30, one).alias("w_end")).distinct()
    files = cu.select("file", serial, F.lit(None).cast("long").alias("file_number"))
    both = F.explode(F.array(F.lit("a"), F.lit("b"))).alias("series")
    mapping = cu.select("p", serial, both).filter((F.col("p") % 5 > 1) | ((F.col("p") % 5 == 1) & (F.col("series") == "a"))).select("serial", "series", F.lit("t").alias("parameter")).distinct()
    days = F.make_dt_interval((F.col("k") % 300).cast("int"))
    spans = cu.select(
        "file", F.get(F.array(*map(F.lit, ("PST", "PDT", "XST"))), (F.col("k") % 4).cast("int")).alias("token"),
        F.when(F.col("k") % 11 == 1, "Nowhere/City").when(F.col("k") % 11 != 0, ZONE).alias("zone"),
        (F.lit("2024-01-05 12:00:00").cast("timestamp_ntz") + days).alias("first_local"), (F.lit("2024-01-25 12:00:00").cast("timestamp_ntz") + days).alias("last_local"),
    )
    return [checks.gate_check(files, deployed), checks.map_check(cu.select("file", serial, both), mapping), checks.zone_check(spans, {"PST": -8.0, "PDT": -7.0})]


def _all_checks(spark, sf_dir):
    found = _edited(spark, sf_dir).select(*checks.check_row("edited", F.size("signs") == 0))
    for more in (_serials(spark, sf_dir), *_gates(spark, sf_dir)):
        found = found.unionByName(more)
    return found


@query(f"""WITH {_COUNTER}, {_SERIALS}, {_GATES} SELECT file, 'edited' AS "check", CASE WHEN signs = '' THEN 'pass' ELSE 'fail' END AS status, '' AS detail FROM signs UNION ALL SELECT file, 'serial', status, recorded FROM sn
UNION ALL SELECT * FROM gate UNION ALL SELECT * FROM map UNION ALL SELECT * FROM zone""")
def logger_file_checks(spark, sf_dir):
    return _all_checks(spark, sf_dir)


@query(f"""WITH {_COUNTER}, {_SERIALS}, {_GATES}, f AS (SELECT file FROM signs UNION SELECT file FROM sn)
SELECT file, CASE WHEN gate.status = 'fail' THEN 'registry gate' WHEN map.status = 'fail' THEN 'series map' WHEN zone.status <> 'pass' THEN 'time zone' END AS blocked_by,
CASE WHEN gate.status = 'fail' OR map.status = 'fail' OR zone.status <> 'pass' THEN 'quarantined' ELSE 'accepted' END AS outcome FROM f LEFT JOIN gate USING (file) LEFT JOIN map USING (file) LEFT JOIN zone USING (file)""")
def blocked_files(spark, sf_dir):
    return checks.logger_outcome(_all_checks(spark, sf_dir))


@query(f"""WITH {SQL_LOGGER}, own AS (SELECT file, series, count(value) AS n, min(value) AS lo, max(value) AS hi, round(sum(value::DECIMAL(28,9))::DOUBLE / count(value), 9) AS mean FROM lg GROUP BY ALL),
rep AS (SELECT 'U' || user_id AS file, event_type AS series, count(*) AS n, min(value) AS lo, max(value) AS hi, round(sum(value::DECIMAL(28,9))::DOUBLE / count(value), 9) AS mean FROM events GROUP BY ALL)
SELECT file, 'statistics' AS "check", CASE WHEN own.n = rep.n AND round(own.lo, 2) = round(rep.lo, 2) AND round(own.hi, 2) = round(rep.hi, 2) AND round(own.mean, 2) = round(rep.mean, 2) THEN 'pass' ELSE 'fail' END AS status, series AS detail
FROM rep LEFT JOIN own USING (file, series)""")
def statistics_checks(spark, sf_dir):
    reported = v.read(spark, sf_dir, "events").groupBy(F.concat(F.lit("U"), "user_id").alias("file"), F.col("event_type").alias("series")).agg(
        F.count("*").alias("rep_n"), F.min("value").alias("rep_min"), F.max("value").alias("rep_max"), stats.exact_mean(F.col("value")).alias("rep_mean")
    )
    return checks.statistics_check(_logger(spark, sf_dir), reported)


@query("""WITH r AS (SELECT DISTINCT 'S' || (l_suppkey % 5) || '-' || strftime(l_shipdate, '%Y-%m') AS file, l_shipdate AS t FROM lineitem),
d AS (SELECT *, epoch(t) - epoch(lag(t) OVER (PARTITION BY file ORDER BY t)) AS dt FROM r), own AS (SELECT file, min(t) AS a, max(t) AS b, count(DISTINCT dt) AS n, min(dt) AS dt FROM d GROUP BY 1)
SELECT file, 'events' AS "check", CASE WHEN a = date_trunc('month', a) AND b = last_day(a)::TIMESTAMP AND n <= 1 AND coalesce(dt = 86400, true) THEN 'pass' ELSE 'fail' END AS status, '' AS detail FROM own""")
def event_checks(spark, sf_dir):
    day = F.col("l_shipdate").cast("timestamp_ntz")
    file = F.concat(F.lit("S"), F.col("l_suppkey") % 5, F.lit("-"), F.date_format("l_shipdate", "yyyy-MM"))
    rows = v.read(spark, sf_dir, "lineitem").select(file.alias("file"), day.alias("timestamp_local")).distinct()
    events = rows.select(
        "file", F.trunc("timestamp_local", "month").cast("timestamp_ntz").alias("started"), F.last_day("timestamp_local").cast("timestamp_ntz").alias("ended"), F.lit(86400.0).alias("interval_s")
    ).distinct()
    return checks.events_check(rows, events)


_TOKENS = ("PST", "PDT", "XST")


@query(f"""WITH s AS (SELECT o_orderkey AS file, {_sql_pick('o_orderkey', *_TOKENS)} AS token, o_orderdate + INTERVAL 12 HOUR AS a, o_orderdate + INTERVAL 732 HOUR AS b FROM orders),
h AS (SELECT file, token, epoch(a - timezone('UTC', timezone('{ZONE}', a))) / 3600 AS ha, epoch(b - timezone('UTC', timezone('{ZONE}', b))) / 3600 AS hb, CASE token WHEN 'PST' THEN -8 WHEN 'PDT' THEN -7 END AS want FROM s)
SELECT file, 'time zone' AS "check", CASE WHEN want IS NULL OR ha <> want OR ha <> hb THEN 'warn' ELSE 'pass' END AS status, token AS detail FROM h""")
def zone_checks(spark, sf_dir):
    at = F.col("o_orderdate").cast("timestamp_ntz")
    spans = v.read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("file"), _pick("o_orderkey", *_TOKENS).alias("token"), F.lit(ZONE).alias("zone"),
        (at + F.expr("interval 12 hours")).alias("first_local"), (at + F.expr("interval 732 hours")).alias("last_local"),
    )
    return checks.zone_check(spans, {"PST": -8.0, "PDT": -7.0})


@query(f"""SELECT o_orderkey, CASE WHEN o_orderkey % 8 <> 0 THEN timezone('UTC', timezone('{ZONE}', o_orderdate + INTERVAL 6 HOUR)) END AS w_start,
CASE WHEN o_orderkey % 8 <> 0 THEN timezone('UTC', timezone('{ZONE}', o_orderdate + INTERVAL 738 HOUR)) END AS w_end FROM orders""")
def deployment_windows(spark, sf_dir):
    at = F.col("o_orderdate").cast("timestamp_ntz")
    end = F.when(F.col("o_orderkey") % 8 != 0, at + F.expr("interval 738 hours"))
    a, b = calendar.window_utc(at + F.expr("interval 6 hours"), end, F.lit(ZONE))
    return v.read(spark, sf_dir, "orders").select("o_orderkey", a.alias("w_start"), b.alias("w_end"))


@query(f"""WITH e AS (SELECT 'U' || user_id AS file, user_id, event_type, date_trunc('minute', ts)::TIMESTAMP AS l, CASE WHEN event_id % 97 <> 0 THEN value END AS value FROM events),
z AS (SELECT *, l + (timezone('UTC', timezone('{ZONE}', min(l) OVER (PARTITION BY file))) - min(l) OVER (PARTITION BY file)) AS t FROM e), i AS (SELECT *, t BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' AS inside FROM z)
SELECT t AS timestamp, 'S' || (user_id % 10) AS site_id, CASE event_type WHEN 'click' THEN 'temperature' ELSE 'light' END AS parameter, round(CASE WHEN event_type = 'click' THEN (value - 32) * 5 / 9 ELSE value END, 6) AS value,
5.0::DOUBLE * (user_id % 3) AS depth_m, (CASE WHEN value IS NULL THEN 9 WHEN inside THEN 2 ELSE 4 END)::TINYINT AS qc_flag, CASE WHEN inside THEN 'deployment_window:pass' ELSE 'deployment_window:fail' END AS qc_tests, 'logger' AS source, 'run-0' AS fetch_run_id
FROM i WHERE event_type IN ('click', 'view')""")
def logger_observations(spark, sf_dir):
    rows = _logger(spark, sf_dir).withColumn("unit", F.when(F.col("series") == "click", "degF").otherwise("degC"))
    mapping = spark.createDataFrame([("click", "temperature"), ("view", "light")], "series string, parameter string")
    user = F.col("user_id")
    deployments = v.read(spark, sf_dir, "events").select("user_id").distinct().select(
        F.concat(F.lit("U"), user).alias("file"), F.concat(F.lit("S"), user % 10).alias("site_id"), (5.0 * (user % 3)).alias("depth_m"), F.lit(ZONE).alias("zone"),
        F.lit("2024-01-05").cast("timestamp_ntz").alias("w_start"), F.lit("2024-01-20").cast("timestamp_ntz").alias("w_end"),
    )
    return text.logger_observations(rows, mapping, deployments)


@query("""WITH r AS (SELECT DISTINCT user_id AS file, event_type AS series, ts::DATE AS day FROM events WHERE event_id % 7 = 5 AND value IS NOT NULL)
SELECT file, series, count(*) AS n_days, string_agg(day::VARCHAR, ',' ORDER BY day) FILTER (WHERE rn <= 5) AS first_days FROM (SELECT *, row_number() OVER (PARTITION BY file, series ORDER BY day) AS rn FROM r) GROUP BY ALL""")
def first_flagged_days(spark, sf_dir):
    rows = _events(spark, sf_dir).select(F.col("user_id").alias("file"), F.col("event_type").alias("series"), F.col("ts").alias("timestamp"), (F.col("event_id") % 7).alias("flag"), "value")
    return checks.first_flagged(rows).withColumn("first_days", F.array_join(F.col("first_days").cast("array<string>"), ","))


# --- headers, grids and registries ----------------------------------------------------------------


@query("""SELECT o_orderkey AS file, o_orderpriority AS "column", o_orderstatus AS unit, CASE o_orderpriority WHEN '1-URGENT' THEN 'F' ELSE 'O' END AS expected FROM orders
WHERE (o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F') OR (o_orderpriority = '2-HIGH' AND o_orderstatus <> 'O')""")
def unit_faults(spark, sf_dir):
    headers = v.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("file"), F.col("o_orderpriority").alias("column"), F.col("o_orderstatus").alias("unit"))
    return checks.units(headers, {"1-URGENT": "F", "2-HIGH": "O"})


@query("""SELECT o_custkey AS file, 'longitude sign' AS "check", CASE WHEN min(o_totalprice - 20000) > 0 THEN 'pass' ELSE 'fail' END AS status, count(*)::VARCHAR AS detail FROM orders GROUP BY 1""")
def longitude_signs(spark, sf_dir):
    rows = v.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("file"), (F.col("o_totalprice") - 20000).alias("longitude"))
    return checks.longitude_sign(rows)


@query("""WITH a AS (SELECT DISTINCT c_nationkey AS file, c_custkey % 40 * 0.01::DOUBLE AS lat FROM customer), d AS (SELECT file, lat - lag(lat) OVER (PARTITION BY file ORDER BY lat) AS d FROM a),
m AS (SELECT file, median(d) AS m FROM d GROUP BY 1) SELECT file, 'lat step' AS "check", CASE WHEN abs(m - 0.01::DOUBLE) <= 0.0001::DOUBLE THEN 'pass' ELSE 'fail' END AS status, round(m, 6) AS step FROM m""")
def grid_steps(spark, sf_dir):
    rows = v.read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("file"), (F.col("c_custkey") % 40 * 0.01).alias("lat"))
    return checks.grid_step(rows, "lat").select("file", "check", "status", F.col("detail").cast("double").alias("step"))


@query("""WITH h AS (SELECT c_custkey AS file, c_custkey % 10 <> 0 AS pinned, c_custkey % 4 <> 1 AS near, c_custkey % 3 <> 1 AS depths, c_nationkey % 6 <> 1 AS legend, c_nationkey - 10 AS late FROM customer),
r AS (SELECT file, unnest([{'c': 'position', 's': CASE WHEN pinned AND near THEN 'pass' ELSE 'fail' END}, {'c': 'legend', 's': CASE WHEN pinned AND legend THEN 'pass' ELSE 'fail' END},
{'c': 'depths', 's': CASE WHEN pinned AND depths THEN 'pass' ELSE 'fail' END}, {'c': 'archive date', 's': CASE WHEN NOT pinned OR late < 0 THEN 'fail' WHEN late = 0 THEN 'pass' ELSE 'warn' END}]) AS x FROM h)
SELECT file, x.c AS "check", x.s AS status FROM r""")
def shore_pin_checks(spark, sf_dir):
    c = v.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("file"), F.col("c_nationkey").alias("n"))
    legend = lambda word: F.create_map(F.lit("0"), F.lit("good"), F.lit("5"), word)
    headers = c.select(
        "file", (32 + F.col("n") * 0.001).alias("latitude"), (-117 - F.col("n") * 0.001).alias("longitude"), F.lit(0.5).alias("surface_m"), (5.0 + F.col("n")).alias("bottom_m"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("n")).alias("archive_date"), legend(F.when(F.col("n") % 6 == 1, "bad").otherwise("void")).alias("legend"),
    )
    off, deep = F.when(F.col("file") % 4 == 1, 1).otherwise(0), F.when(F.col("file") % 3 == 1, 1).otherwise(0)
    pins = c.filter("file % 10 <> 0").select(
        "file", (32 + (F.col("n") + off) * 0.001).alias("site_lat"), (-117 - F.col("n") * 0.001).alias("site_lon"), F.lit(0.5).alias("site_surface_m"), (5.0 + F.col("n") + deep).alias("site_bottom_m"),
        F.lit("2020-01-11").cast("date").alias("site_archive_date"), legend(F.lit("void")).alias("site_legend"),
    )
    return checks.shore_pins(headers, pins).select("file", "check", "status")


@query("""WITH p AS (SELECT c_custkey AS k, 'P' || c_nationkey AS polygon_id FROM customer WHERE c_custkey % 5 <> 0 UNION ALL SELECT c_custkey, 'Q' || c_nationkey FROM customer WHERE c_custkey % 7 = 0),
o AS (SELECT k, min(polygon_id) AS polygon_id FROM p GROUP BY 1 HAVING count(*) = 1)
SELECT c_custkey AS file, polygon_id, CASE WHEN polygon_id IS NULL THEN 'quarantined' ELSE 'accepted' END AS outcome FROM customer LEFT JOIN o ON k = c_custkey""")
def polygon_of_files(spark, sf_dir):
    c = v.read(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "file")
    named = lambda letter: F.concat(F.lit(letter), "c_nationkey").alias("polygon_id")
    declared = c.filter("file % 5 <> 0").select("file", named("P")).unionByName(c.filter("file % 7 = 0").select("file", named("Q")))
    return checks.canopy_file_polygon(c.select("file"), declared)


@query("""SELECT 'P' || (o_custkey % 6) AS polygon_id, o_orderpriority AS revision, count(DISTINCT o_custkey) AS n_files FROM orders GROUP BY ALL HAVING count(DISTINCT o_custkey) > 1""")
def landings_repeated(spark, sf_dir):
    files = v.read(spark, sf_dir, "orders").select(F.concat(F.lit("P"), F.col("o_custkey") % 6).alias("polygon_id"), F.col("o_orderpriority").alias("revision"), F.col("o_custkey").alias("file"))
    return checks.repeated_landings(files)


@query("SELECT o_custkey AS polygon_id, year(o_orderdate)::INT AS year, quarter(o_orderdate)::TINYINT AS quarter, count(*) AS n_rows FROM orders GROUP BY ALL HAVING count(*) > 1")
def quarters_repeated(spark, sf_dir):
    rows = v.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("polygon_id"), F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").cast("tinyint").alias("quarter"))
    return features.duplicates(rows, "polygon_id", "year", "quarter")


@query("""WITH s AS (SELECT c_custkey AS site_id, CASE WHEN c_nationkey < 10 THEN 'C' || c_nationkey END AS code, CASE WHEN c_custkey % 3 = 0 THEN [NULL] ELSE ['R' || c_nationkey, 'R' || (c_custkey % 7)] END AS refs FROM customer
WHERE c_mktsegment = 'MACHINERY' AND (c_nationkey < 10 OR c_custkey % 2 = 0)) SELECT site_id, code, unnest(refs) AS ref FROM s""")
def stations_of_operator(spark, sf_dir):
    none, key = F.array().cast("array<string>"), F.col("c_custkey")
    sites = v.read(spark, sf_dir, "customer").select(
        key.alias("site_id"), F.col("c_mktsegment").alias("operator"), F.when(F.col("c_nationkey") < 10, F.concat(F.lit("C"), "c_nationkey")).alias("code"),
        F.when(key % 2 == 0, F.array(F.lit("old"))).otherwise(none).alias("datasets"),
        F.when(key % 3 == 0, none).otherwise(F.array(F.concat(F.lit("R"), "c_nationkey"), F.concat(F.lit("R"), key % 7))).alias("neighbor_refs"),
    )
    return checks.public_stations(sites, "MACHINERY")


@query("""WITH f AS (SELECT o_orderkey AS file, 'SN' || (o_custkey % 50) AS serial, o_orderkey % 5 AS n FROM orders), d AS (SELECT DISTINCT 'SN' || (c_custkey % 60) AS serial, c_nationkey::BIGINT AS number FROM customer WHERE c_custkey % 60 < 40 AND (c_custkey % 60 < 30 OR c_nationkey = 3)),
j AS (SELECT file, number, n, count(number) OVER (PARTITION BY file) AS k FROM f LEFT JOIN d USING (serial)), o AS (SELECT file, min(number) AS number FROM j WHERE k = 1 OR number = n GROUP BY 1)
SELECT file, serial, number::VARCHAR AS deployment_number, CASE WHEN number IS NULL THEN 'quarantined' ELSE 'accepted' END AS outcome FROM f LEFT JOIN o USING (file)""")
def deployments_of_files(spark, sf_dir):
    files = v.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("file"), F.concat(F.lit("SN"), F.col("o_custkey") % 50).alias("serial"), (F.col("o_orderkey") % 5).alias("file_number"))
    place = F.col("c_custkey") % 60
    known = (place < 40) & ((place < 30) | (F.col("c_nationkey") == 3))
    at = lambda day: F.when(known, F.lit(day).cast("timestamp_ntz"))
    deployed = v.read(spark, sf_dir, "customer").select(
        F.concat(F.lit("SN"), place).alias("serial"), F.col("c_nationkey").cast("long").alias("deployment_number"), F.lit("2024-01-01").cast("timestamp_ntz").alias("w_start"), at("2024-02-01").alias("w_end")
    )
    return checks.registry_gate(files, deployed).withColumn("deployment_number", F.col("deployment_number").cast("string"))


@query("""WITH s AS (SELECT DISTINCT user_id AS file, user_id % 10 AS serial, event_type AS series FROM events), m AS (SELECT DISTINCT user_id % 10 AS serial, event_type AS series FROM events WHERE user_id % 10 <> 4 AND (user_id % 10 + length(event_type)) % 3 <> 0)
SELECT file, count(*) AS n_series, count(m.series) AS n_mapped, CASE WHEN count(m.series) = 0 THEN 'fail' WHEN count(m.series) < count(*) THEN 'warn' ELSE 'pass' END AS status FROM s LEFT JOIN m ON s.serial = m.serial AND s.series = m.series GROUP BY 1""")
def series_mapped(spark, sf_dir):
    e = v.read(spark, sf_dir, "events").select(F.col("user_id").alias("file"), (F.col("user_id") % 10).alias("serial"), F.col("event_type").alias("series")).distinct()
    known = e.filter((F.col("serial") != 4) & ((F.col("serial") + F.length("series")) % 3 != 0)).select("serial", "series", F.col("series").alias("parameter")).distinct()
    return checks.series_map_gate(e, known)


@query("""WITH d AS (SELECT o_custkey AS site, o_orderstatus AS parameter, o_orderkey AS k, o_orderdate AS a, o_orderdate + INTERVAL 90 DAY AS b, CASE WHEN o_orderkey % 3 <> 0 THEN (o_orderkey % 2)::DOUBLE END AS depth FROM orders)
SELECT x.k AS a_deployment_number, y.k AS b_deployment_number FROM d x JOIN d y ON x.site = y.site AND x.parameter = y.parameter AND x.depth IS NOT DISTINCT FROM y.depth AND x.k < y.k AND x.a <= y.b AND y.a <= x.b""")
def deployments_overlapping(spark, sf_dir):
    at, k = F.col("o_orderdate").cast("timestamp_ntz"), F.col("o_orderkey")
    deployed = v.read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("site_id"), F.lit("SN").alias("serial"), k.alias("deployment_number"), F.col("o_orderstatus").alias("parameter"),
        F.when(k % 3 != 0, (k % 2).cast("double")).alias("depth_m"), at.alias("w_start"), (at + F.expr("interval 90 days")).alias("w_end"),
    )
    return features.overlapping_deployments(deployed).select("a_deployment_number", "b_deployment_number")
