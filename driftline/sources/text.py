"""Scans of landed measurement files. Each reads a directory and keeps the file's name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driftline.functions import calendar, fields, verdicts
from driftline.operators.watch import Watch, counted
from driftline.sources import headed

#: Buoy columns and their parameter, unit, sentinel in archive files, and column order of time.
BUOY_COLUMNS = {
    "WTMP": ("sea_water_temperature", "degC", 999.0), "ATMP": ("air_temperature", "degC", 999.0), "WVHT": ("wave_significant_height", "m", 99.0),
    "DPD": ("wave_peak_period", "sec", 99.0), "WSPD": ("wind_speed", "m/s", 99.0),
}
BUOY_TIME = {"year": "YY", "month": "MM", "day": "DD", "hour": "hh", "minute": "mm"}
#: The provider's tests, in the order of their digits.
PROVIDER_TESTS = (
    "gap", "syntax", "location", "gross_range", "climatology", "spike", "rate_of_change", "flat_line", "multi_variate", "attenuated_signal", "neighbor",
)
DEPTH_COLUMNS = {"T_1m": 1.0, "T_6m": 6.0, "T_15m": 15.0, "T_21m": 21.0, "T_32m": 32.0, "T_45m": 45.0, "T_57m": 57.0, "T_72m": 72.0, "T_90m": 90.0}


def lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """file, line of every text line; gzip files are read as they are."""
    return spark.read.option("encoding", encoding).text(path).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("line"))


def _observation(site: Column, source: str, run: str, *, parameter: Column, depth: Column, tests: Column | None = None, flag: Column | None = None) -> list[Column]:
    return [
        F.col("timestamp"), site.alias("site_id"), parameter.alias("parameter"), F.col("value"), depth.cast("double").alias("depth_m"),
        (verdicts.ingest_flag(F.col("value")) if flag is None else flag).alias("qc_flag"), (F.lit("") if tests is None else tests).alias("qc_tests"),
        F.lit(source).alias("source"), F.lit(run).alias("fetch_run_id"),
    ]


def buoy(spark: SparkSession, path: str, stations: DataFrame, run: str = "run-0", range_bytes: int = headed.RANGE) -> DataFrame:
    """Observations of buoy text files, realtime or archive, plain or gzipped.

    The two head lines of each file name its columns and their units; a ``PTDY`` column marks the
    realtime layout, whose missing mark is ``MM``, while archive files use sentinels of nines. Only the
    parameters that a station declares become rows. ``stations`` has station (the
    file name's part before the first ``_``, ``h`` or dot), parameter and depth_m. A file
    without two head lines, with other time columns, or with a column in another unit than
    is expected is refused.
    """
    units = {c: unit for c, (_, unit, _) in BUOY_COLUMNS.items()}
    raw = headed.read(spark, path, "hash", BUOY_TIME | {c: c for c in BUOY_COLUMNS}, ["PTDY"], units, list(BUOY_TIME.values()), range_bytes)
    time = fields.five_column_time(*(F.col(c) for c in BUOY_TIME))
    values = [
        F.struct(F.lit(p).alias("parameter"), F.when(F.col("has_PTDY"), fields.number(F.col(c))).otherwise(fields.number(F.col(c), s)).alias("value"))
        for c, (p, _, s) in BUOY_COLUMNS.items()
    ]
    out = raw.select("file", time.alias("timestamp"), F.explode(F.array(*values)).alias("v")).select(
        F.regexp_extract("file", r"^([^_h.]+)", 1).alias("station"), "timestamp", "v.parameter", "v.value"
    )
    return out.join(stations, ["station", "parameter"]).select(
        *_observation(F.concat(F.lit("BUOY:"), F.col("station")), "buoy", run, parameter=F.col("parameter"), depth=F.col("depth_m"))
    )


def _csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=False).select("*", F.col("_metadata.file_name").alias("file"))


def header_units(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """file, column, unit from the second line of each file, for :func:`checks.units`."""
    rows = _csv(spark, path, columns).filter(F.col(columns[0]) == "UTC")
    return rows.select("file", F.explode(F.map_from_arrays(F.array(*map(F.lit, columns)), F.array(*(F.col(c) for c in columns)))).alias("column", "unit"))


PROFILE_COLUMNS = ["time", "latitude", "longitude", "z", "sea_water_temperature", "sea_water_temperature_qc_agg", "sea_water_temperature_qc_tests"]


def moored_profile(spark: SparkSession, path: str, declared: DataFrame, run: str = "run-0") -> DataFrame:
    """Observations of moored profiles with the provider's own verdicts.

    Altitudes become depths. At a site that declares depths only those count, and an
    absent reading at a time when no declared depth has one is not a measurement at
    all and goes; at an undeclared site rows with a reading stay. The flag follows the
    provider's aggregate, 9 where there is no value. ``declared`` has site_id, depth_m.
    """
    raw = _csv(spark, path, PROFILE_COLUMNS).filter("time <> 'UTC'")
    rows = raw.select(
        F.regexp_replace(F.regexp_extract("file", r"^(.*?)_\d{4}-", 1), "^$", "unknown").alias("site_id"), F.to_timestamp_ntz(F.regexp_replace("time", "Z$", "")).alias("timestamp"),
        fields.depth_of_altitude(fields.number(F.col("z"))).alias("depth_m"), fields.number(F.col("sea_water_temperature")).alias("value"),
        F.col("sea_water_temperature_qc_agg").try_cast("tinyint").alias("agg"), F.col("sea_water_temperature_qc_tests").alias("digits"),
    )
    sites = declared.select("site_id").distinct().withColumn("declares", F.lit(True))
    # the registry goes to the rows: a shuffle by site would put a whole site in one task
    rows = rows.join(F.broadcast(sites), "site_id", "left").join(F.broadcast(declared.withColumn("known", F.lit(True))), ["site_id", "depth_m"], "left")
    rows = rows.filter(F.when(F.col("declares"), F.col("known")).otherwise(F.col("value").isNotNull()))
    any_value = F.max(F.col("value").isNotNull()).over(W.partitionBy("site_id", "timestamp"))
    rows = rows.withColumn("any_value", any_value).filter("any_value")
    decoded = verdicts.decode_digits(F.col("digits"), PROVIDER_TESTS)
    flag = F.when(F.col("value").isNull(), 9).otherwise(F.coalesce("agg", F.lit(2))).cast("tinyint")
    return rows.select(*_observation(F.col("site_id"), "moored_profile", run, parameter=F.lit("sea_water_temperature"), depth=F.col("depth_m"), tests=verdicts.describe(decoded), flag=flag))


def surprise_depths(rows: DataFrame, declared: DataFrame) -> DataFrame:
    """Depths with readings that a declaring site does not declare."""
    sites = declared.select("site_id").distinct()
    return rows.filter("value is not null").join(sites, "site_id", "left_semi").join(declared, ["site_id", "depth_m"], "left_anti").groupBy("site_id", "depth_m").agg(F.count("*").alias("n_rows"))


def provider_disagreement(obs: DataFrame) -> DataFrame:
    """Rows whose provider flag is not what its own verdicts roll up to, by site."""
    own = verdicts.rollup(F.map_values(verdicts.parse(F.col("qc_tests"))))
    return obs.groupBy("site_id").agg(F.count_if((F.col("qc_flag") != 9) & (F.col("qc_flag") != own)).alias("n_disagree"), F.count("*").alias("n_rows"))


def depth_columns(spark: SparkSession, path: str, site: str, run: str = "run-0") -> DataFrame:
    """Observations of a file with one column for each depth; absent readings stay, flagged 9."""
    columns = ["time", "latitude", "longitude", *DEPTH_COLUMNS]
    raw = _csv(spark, path, columns).filter("time <> 'UTC'").select(F.to_timestamp_ntz(F.regexp_replace("time", "Z$", "")).alias("timestamp"), *(fields.number(F.col(c)).alias(c) for c in DEPTH_COLUMNS))
    long = raw.unpivot(["timestamp"], list(DEPTH_COLUMNS), "column", "value")
    depth = F.create_map(*[F.lit(x) for kv in DEPTH_COLUMNS.items() for x in kv])
    return long.select(*_observation(F.lit(site), "depth_columns", run, parameter=F.lit("sea_water_temperature"), depth=F.element_at(depth, F.col("column"))))


def grid(spark: SparkSession, path: str, fill: float = -7.768) -> DataFrame:
    """site_id, day, latitude, longitude, value of daily grid files; the fill value is no value."""
    raw = _csv(spark, path, ["time", "latitude", "longitude", "analysed_sst"]).filter("time <> 'UTC'")
    return raw.select(
        F.regexp_extract("file", r"^(.*?)_(?:\d|edge)", 1).alias("site_id"), F.to_timestamp_ntz(F.regexp_replace("time", "Z$", "")).alias("timestamp"),
        fields.number(F.col("latitude")).alias("latitude"), fields.number(F.col("longitude")).alias("longitude"), fields.number(F.col("analysed_sst"), fill).alias("value"),
    )


CANOPY_COLUMNS = ["year", "quarter", "kelp_area_m2", "count_cells_kelp", "count_cells_no_clouds", "count_cells_historic_footprint"]


def canopy(spark: SparkSession, path: str, polygons: DataFrame, watch: Watch | None = None) -> DataFrame:
    """Quarterly response files: derived ``max`` rows go, an unobserved quarter has no area, another quarter is refused.

    ``polygons`` has file and polygon_id; a file that none names gives no rows. ``watch`` counts the derived rows.
    """
    q = F.col("quarter")
    unknown = ~F.coalesce(q.isin("1", "2", "3", "4", "max"), F.lit(False))
    raw = headed.read(spark, path, "names", CANOPY_COLUMNS, first=CANOPY_COLUMNS).withColumn("quarter", fields.refused(unknown, "an unknown quarter", q, "string"))
    raw = counted(watch, raw, "canopy", derived_rows_dropped=q == "max").filter("quarter <> 'max'")
    cells = F.col("count_cells_no_clouds").try_cast("int")
    rows = raw.select(
        "file", F.col("year").try_cast("int").alias("year"), F.col("quarter").try_cast("tinyint").alias("quarter"),
        fields.canopy_missing(fields.number(F.col("kelp_area_m2")), cells).alias("area_m2"), fields.canopy_missing(fields.number(F.col("count_cells_kelp")), cells).alias("n_cells_canopy"),
        cells.alias("n_cells_observed"), F.col("count_cells_historic_footprint").try_cast("int").alias("n_cells"),
    )
    return rows.join(polygons, "file")


def derived_rows(spark: SparkSession, path: str) -> DataFrame:
    """By file how many derived rows were dropped and how many had an unknown quarter."""
    q = F.col("quarter")
    return _csv(spark, path, CANOPY_COLUMNS).groupBy("file").agg(
        F.count_if(q == "max").alias("n_derived"), F.count_if(~q.isin("1", "2", "3", "4", "max")).alias("n_unknown"), F.count("*").alias("n_in")
    )


def _whole(spark: SparkSession, path: str) -> DataFrame:
    """file and text of each archive, UTF-8 with or without a mark, else latin-1."""
    raw = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "content")
    utf = F.try_validate_utf8(F.col("content").cast("string"))
    return raw.select("file", F.regexp_replace(F.coalesce(utf, F.decode("content", "ISO-8859-1")), "^﻿|\r", "").alias("text"))


def shore_header(spark: SparkSession, path: str) -> DataFrame:
    """One row of facts for each archive from its preamble: station, position, depths, date, DOI, legend."""
    find = lambda p, i=1: F.nullif(F.regexp_extract("text", p, i), F.lit(""))
    return _whole(spark, path).select(
        "file", F.trim(find(r"(?im)^\W*station\W+([^,\n]+)")).alias("station"),
        fields.dms(find(r"(\d+\D+\d+\D+[\d.]+\D{0,3}[NS])\b")).alias("latitude"), fields.dms(find(r"(\d+\D{1,3}\d+\D{1,3}[\d.]+\D{0,3}[EW])\b")).alias("longitude"),
        find(r"(?i)surface[^\n\d]*?([\d.]+)\s*m\b").try_cast("double").alias("surface_m"), find(r"(?i)bottom[^\n\d]*?([\d.]+)\s*m\b").try_cast("double").alias("bottom_m"),
        F.to_date(find(r"(\d{4}-\d{2}-\d{2})")).alias("archive_date"), find(r"(10\.\d{4,}/[^\s,\"]+)").alias("doi"),
        F.map_from_entries(F.array_distinct(F.arrays_zip(F.regexp_extract_all("text", F.lit(r"(?m)^\W*([0-5])\s*[=:-]\s*[^,\n]+"), 1), F.regexp_extract_all("text", F.lit(r"(?m)^\W*[0-5]\s*[=:-]\s*([^,\n]+)"), 1)))).alias("legend"),
    )


SHORE_COLUMNS = ["YEAR", "MONTH", "DAY", "TIME_PST", "TIME_FLAG", "SURF_TEMP_C", "SURF_FLAG", "BOT_TEMP_C", "BOT_FLAG"]


def shore_archive(spark: SparkSession, path: str, surface_m: float, bottom_m: float, site: str, run: str = "run-0", range_bytes: int = headed.RANGE) -> DataFrame:
    """Two depth series from shore archives below a free-text preamble.

    Times are HHMM in a fixed eight hours behind UTC, 10:38 where none is given. A
    series keeps only days with a value or a flag; source flags become verdicts.
    """
    cells = headed.read(spark, path, "year", SHORE_COLUMNS, first=SHORE_COLUMNS, range_bytes=range_bytes)
    num = lambda i: fields.number(F.col(SHORE_COLUMNS[i]))
    rows = cells.select(
        "file", *(num(i).try_cast("int").alias(n) for i, n in enumerate(("y", "m", "d", "t", "tf"))), num(5).alias("sv"), num(6).try_cast("int").alias("sf"), num(7).alias("bv"), num(8).try_cast("int").alias("bf"),
    )
    # padding rows go; a part of a date, a day that is none or comes twice, and a clock that is none are refused
    given = F.array_size(F.array_compact(F.array("y", "m", "d")))
    rows = rows.filter(given > 0).withColumn("day", F.try_make_timestamp_ntz("y", "m", "d", F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)")))
    rows = rows.withColumn("days", F.count("*").over(W.partitionBy("file", "y", "m", "d")))
    rows = rows.withColumn("y", fields.refused((given < 3) | F.col("day").isNull(), "a date in part", F.col("y"), "int"))
    rows = rows.withColumn("y", fields.refused(F.col("days") > 1, "a repeated day", F.col("y"), "int"))
    minute = calendar.clock(F.col("t"))
    minute = fields.refused(minute.isNull(), "a clock beyond its range", minute, "int")
    local = F.try_make_timestamp_ntz("y", "m", "d", F.floor(minute / 60).cast("int"), F.pmod(minute, F.lit(60)).cast("int"), F.lit(0).cast("decimal(16,6)"))
    two = F.explode(F.array(*(F.struct(F.lit(z).alias("depth_m"), F.col(v).alias("value"), F.col(f).alias("flag")) for z, v, f in ((surface_m, "sv", "sf"), (bottom_m, "bv", "bf")))))
    rows = rows.select((local + F.expr("interval 8 hours")).alias("timestamp"), F.when(F.col("t").isNotNull(), F.col("tf")).alias("tf"), two.alias("s")).select("timestamp", "tf", "s.*")
    rows = rows.filter("value is not null or flag is not null")
    missing = F.col("value").isNull()
    tests = F.map_filter(
        F.create_map(F.lit("source_flag"), F.when(missing, "missing").otherwise(verdicts.source_code_status(F.col("flag"))), F.lit("time_flag"), verdicts.source_code_status(F.col("tf"))),
        lambda k, v: v.isNotNull(),
    )
    return rows.select(*_observation(F.lit(site), "shore_archive", run, parameter=F.lit("sea_water_temperature"), depth=F.col("depth_m"), tests=verdicts.describe(tests), flag=verdicts.rollup(F.map_values(tests))))


def logger_rows(sheets: DataFrame, series_columns: list[str]) -> DataFrame:
    """Extracted logger sheets (file, row_number, timestamp_local, one column for each series) in long form.

    A column's header is ``name , unit``; rows without a time are left out.
    """
    long = sheets.filter("timestamp_local is not null").unpivot(["file", "row_number", "timestamp_local"], series_columns, "header", "value")
    return long.select(
        "file", "row_number", "timestamp_local", F.trim(F.regexp_extract("header", r"^(.*?)\s*,", 1)).alias("series"), F.trim(F.regexp_extract("header", r",\s*([^,]*)$", 1)).alias("unit"), "value"
    )


def logger_observations(rows: DataFrame, mapping: DataFrame, deployments: DataFrame, target: str = "degC", run: str = "run-0", vocabulary: list[str] | None = None, watch: Watch | None = None) -> DataFrame:
    """Logger rows as observations: unit, parameter, one UTC offset for each file, and the window's verdict.

    ``mapping`` has series and parameter, ``deployments`` file, site_id, depth_m, zone, w_start and
    w_end (UTC). A reading outside the closed window is flagged 4, an absent one 9. Rows of a
    series that is not mapped are left out, and ``watch`` counts them; a mapping to a
    parameter outside ``vocabulary`` is refused.
    """
    if vocabulary is not None:
        unknown = ~F.coalesce(F.col("parameter").isin(*vocabulary), F.lit(False))
        mapping = mapping.withColumn("parameter", fields.refused(unknown, "a series mapped to an unknown parameter", F.col("parameter"), "string"))
    first = F.min("timestamp_local").over(W.partitionBy("file"))
    r = rows.withColumn("first_local", first).join(mapping, "series", "left")
    r = counted(watch, r, "logger", rows_of_unmapped_series=F.col("parameter").isNull()).filter("parameter is not null").join(deployments, "file")
    r = r.withColumn("timestamp", calendar.to_utc_at_first(F.col("timestamp_local"), F.col("first_local"), F.col("zone")).cast("timestamp_ntz"))
    r = r.withColumn("value", fields.convert(F.col("value"), F.col("unit"), target))
    inside = F.col("timestamp").between(F.col("w_start"), F.col("w_end"))
    flag = F.when(F.col("value").isNull(), 9).when(inside, 2).otherwise(4).cast("tinyint")
    tests = F.when(inside, "deployment_window:pass").otherwise("deployment_window:fail")
    return r.select(*_observation(F.col("site_id"), "logger", run, parameter=F.col("parameter"), depth=F.col("depth_m"), tests=tests, flag=flag))
