"""Assertions and gates over files and registries, as DataFrames of what fails.

A check row is (file, check, status, detail) with status pass, warn, fail or skipped.
"""

from __future__ import annotations

import zoneinfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driftline.functions import calendar
from driftline.functions.fields import position_matches
from driftline.functions.stats import exact_mean

FLAGS = (1, 2, 3, 4, 9)


def check_row(check: str, ok: Column, detail: Column | str = "", bad: str = "fail") -> list[Column]:
    text = F.lit(detail) if isinstance(detail, str) else detail.cast("string")
    return [F.col("file"), F.lit(check).alias("check"), F.when(ok, "pass").otherwise(bad).alias("status"), text.alias("detail")]


def observation_faults(obs: DataFrame, schema) -> dict[str, int]:
    """What keeps a table from being stored: columns of another name, order or type, and flags outside the set."""
    faults = {} if [(f.name, f.dataType) for f in obs.schema] == [(f.name, f.dataType) for f in schema] else {"schema": 1}
    if "qc_flag" in obs.columns:
        row = obs.agg(F.count_if(~F.coalesce(F.col("qc_flag").isin(*FLAGS), F.lit(False))).alias("n"), F.count_if(F.isnan(F.col("value"))).alias("nan")).first()
        faults |= {k: v for k, v in (("qc_flag", row["n"]), ("nan", row["nan"])) if v}
    return faults


def canopy_counts(landed: DataFrame, cell_area: float = 900.0) -> DataFrame:
    """For each file the rows that break a rule of canopy counts, in one pass."""
    n = F.count_if
    return landed.groupBy("file").agg(
        (F.count("*") - F.count_distinct("year", "quarter")).alias("repeated"), (F.count_distinct("n_cells") - 1).alias("footprints"),
        n(F.col("n_cells_observed") > F.col("n_cells")).alias("observed_over_footprint"),
        n(F.col("n_cells_canopy") > F.col("n_cells_observed")).alias("canopy_over_observed"),
        n(F.col("area_m2") > cell_area * F.col("n_cells_canopy")).alias("area_over_cells"),
        n(F.col("area_m2").isNull() | F.col("n_cells").isNull()).alias("unreadable"),
    )


def shore_pins(headers: DataFrame, pins: DataFrame, tolerance: float = 0.0005) -> DataFrame:
    """Check rows of shore archives against the registry, in order: position, legend, depths, archive date.

    ``headers`` is what the preamble says (file, latitude, longitude, surface_m, bottom_m,
    archive_date, legend); ``pins`` what is registered for a file (file, site_lat,
    site_lon, site_surface_m, site_bottom_m, site_archive_date, site_legend). A file without
    a pin fails every check. An archive newer than its pin warns, since it asks for a
    new look at the rest.
    """
    j = headers.join(pins, "file", "left")
    entries = lambda m: F.array_sort(F.map_entries(m))
    near = position_matches(F.col("latitude"), F.col("longitude"), F.col("site_lat"), F.col("site_lon"), tolerance)
    depths = (F.col("surface_m") == F.col("site_surface_m")) & (F.col("bottom_m") == F.col("site_bottom_m"))
    known = lambda c: F.coalesce(c, F.lit(False))
    date, pin = F.col("archive_date"), F.col("site_archive_date")
    rows = [
        j.select(*check_row("position", known(near), F.concat_ws(",", "latitude", "longitude"))),
        j.select(*check_row("legend", known(entries(F.col("legend")) == entries(F.col("site_legend"))), F.array_join(F.map_keys("legend"), ","))),
        j.select(*check_row("depths", known(depths), F.concat_ws(",", "surface_m", "bottom_m"))),
        j.select("file", F.lit("archive date").alias("check"), F.when(date == pin, "pass").when(date > pin, "warn").otherwise("fail").alias("status"), date.cast("string").alias("detail")),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


#: The order in which a shore archive's checks decide, and in which a logger file's are recorded.
SHORE_ORDER = ["position", "legend", "depths", "archive date"]
LOGGER_ORDER = ["edited", "statistics", "events", "cadence", "time zone", "serial", "registry gate", "series map"]
#: Checks whose failure stops a logger file, in the order to report them; then a zone that is not found right.
LOGGER_BLOCKING = ["registry gate", "series map"]
LOGGER_ZONE = "time zone"


def logger_checks(
    rows: DataFrame, extra_columns: DataFrame, files: DataFrame, events: DataFrame, reported: DataFrame, spans: DataFrame, offsets: dict[str, float],
    deployments: DataFrame, mapping: DataFrame,
) -> DataFrame:
    """All check rows of logger files: signs of editing, reported statistics, events, cadence, zone, serial, deployment, series.

    ``files`` has file, file_serial, recorded_serial and file_number, ``deployments`` serial,
    deployment_number and the window, ``mapping`` serial, series and parameter. What stops a
    file is decided by :func:`logger_outcome`.
    """
    edited = edited_file(rows, extra_columns).select(*check_row("edited", F.size("signs") == 0, F.array_join("signs", ",")))
    cadence = cadence_audit(rows.join(events.select("file", "interval_s"), "file"))
    paced = cadence.select(*check_row("cadence", F.col("n_off") == 0, F.col("n_off"), "warn"))
    own = files.select("file", F.col("recorded_serial").alias("serial"), "file_number")
    series = rows.select("file", "series").distinct().join(own.select("file", "serial"), "file")
    out = edited
    for more in (
        statistics_check(rows, reported), events_check(rows, events), paced, zone_check(spans, offsets), serials(files), gate_check(own, deployments), map_check(series, mapping),
    ):
        out = out.unionByName(more)
    return out


def gate_check(files: DataFrame, deployments: DataFrame) -> DataFrame:
    """:func:`registry_gate` as check rows."""
    return registry_gate(files, deployments).select(*check_row("registry gate", F.col("outcome") == "accepted", F.col("serial")))


def map_check(series: DataFrame, mapping: DataFrame) -> DataFrame:
    """:func:`series_map_gate` as check rows."""
    return series_map_gate(series, mapping).select("file", F.lit("series map").alias("check"), "status", F.concat_ws("/", "n_mapped", "n_series").alias("detail"))


def logger_outcome(checks: DataFrame) -> DataFrame:
    """For each logger file what stops its ingest, if anything.

    A failing registry gate or series map does, and then a time zone check that is not
    passed, be it for a warning or skipped: the offset of the times is then not known. All
    else, such as signs of editing, other statistics, a gap, or a renamed file, is recorded
    and the file is ingested.
    """
    stops = (F.col("check").isin(*LOGGER_BLOCKING) & (F.col("status") == "fail")) | ((F.col("check") == LOGGER_ZONE) & (F.col("status") != "pass"))
    place = F.array_position(F.array(*map(F.lit, [*LOGGER_BLOCKING, LOGGER_ZONE])), F.col("check"))
    first = checks.groupBy("file").agg(F.min(F.when(stops, F.struct(place.alias("place"), F.col("check"))))["check"].alias("blocked_by"))
    return first.select("file", "blocked_by", F.when(F.col("blocked_by").isNull(), "accepted").otherwise("quarantined").alias("outcome"))


def first_flagged(rows: DataFrame, code: int = 5, k: int = 5) -> DataFrame:
    """The first k days on which each series of a file has a reading of a source flag, and how many have one."""
    hit = rows.filter((F.col("flag") == code) & F.col("value").isNotNull())
    days = hit.select("file", "series", F.to_date("timestamp").alias("day")).distinct()
    ranked = days.withColumn("rn", F.row_number().over(W.partitionBy("file", "series").orderBy("day")))
    return ranked.groupBy("file", "series").agg(F.count("*").alias("n_days"), F.array_sort(F.collect_list(F.when(F.col("rn") <= k, F.col("day")))).alias("first_days"))


def units(headers: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Columns whose declared unit is not the expected one; ``headers`` has file, column, unit."""
    table = F.create_map(*[F.lit(x) for kv in expected.items() for x in kv])
    want = F.try_element_at(table, F.col("column"))
    return headers.withColumn("expected", want).filter(want.isNotNull() & ~F.col("unit").eqNullSafe(want))


def longitude_sign(rows: DataFrame, positive: bool = True) -> DataFrame:
    ok = F.bool_and(F.col("longitude") > 0 if positive else F.col("longitude") < 0)
    return rows.groupBy("file").agg(ok.alias("ok"), F.count("*").alias("n")).select(*check_row("longitude sign", F.col("ok"), F.col("n")))


def grid_step(rows: DataFrame, axis: str, step: float = 0.01, tolerance: float = 0.01) -> DataFrame:
    """Median distance of a file's neighbouring grid lines, against the expected step."""
    lines = rows.select("file", axis).distinct()
    d = lines.withColumn("d", F.col(axis) - F.lag(axis).over(W.partitionBy("file").orderBy(axis)))
    m = d.groupBy("file").agg(F.median("d").alias("m"))
    return m.select(*check_row(f"{axis} step", F.abs(F.col("m") - step) <= step * tolerance, F.col("m")))


def edited_file(rows: DataFrame, extra_columns: DataFrame) -> DataFrame:
    """Signs that a logger file was edited by hand: more columns, rows without time, a broken counter."""
    w = W.partitionBy("file").orderBy("line_no")
    c = rows.withColumn("want", F.row_number().over(w))
    per = c.groupBy("file").agg(
        F.count_if(F.col("timestamp_local").isNull()).alias("no_time"), F.count_if(~F.col("row_number").eqNullSafe(F.col("want"))).alias("counter")
    ).join(extra_columns, "file", "left")
    signs = F.array_compact(F.array(
        F.when(F.coalesce("n_extra", F.lit(0)) > 0, "extra columns"), F.when(F.col("no_time") > 0, "rows without time"), F.when(F.col("counter") > 0, "broken counter"),
    ))
    return per.select("file", signs.alias("signs"))


def serials(files: DataFrame) -> DataFrame:
    """The serial in a file's name against the recorded one, which counts: another one warns, none says nothing."""
    one, other = F.col("file_serial"), F.col("recorded_serial")
    same = one.isNull() | other.isNull() | (F.trim(one) == F.trim(other))
    return files.select(*check_row("serial", same, other, "warn"))


def statistics_check(rows: DataFrame, reported: DataFrame) -> DataFrame:
    """A file's count, extremes and mean against those its export reports, to two places.

    The mean is :func:`stats.exact_mean`, so one that lies halfway between two places does not round by the order of the rows.
    """
    own = rows.filter("value is not null").groupBy("file", "series").agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"), exact_mean(F.col("value")).alias("mean"))
    same = lambda a, b: F.round(F.col(a), 2).eqNullSafe(F.round(F.col(b), 2))
    joined = reported.join(own, ["file", "series"], "left")
    ok = F.coalesce(F.col("n") == F.col("rep_n"), F.lit(False)) & same("lo", "rep_min") & same("hi", "rep_max") & same("mean", "rep_mean")
    return joined.select(*check_row("statistics", ok, F.col("series")))


def file_summary(rows: DataFrame) -> DataFrame:
    """n, first, last, min, max and mean of each series of a file."""
    return rows.groupBy("file", "series").agg(
        F.count("value").alias("n"), F.min("timestamp_local").alias("first_at"), F.max("timestamp_local").alias("last_at"),
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.avg("value").alias("mean"),
    )


def cadence_audit(rows: DataFrame, interval: str = "interval_s") -> DataFrame:
    """Usual spacing of a file (the least of equally frequent ones), spacings that differ from the configured one, and the first three such times."""
    d = rows.withColumn("dt", calendar.seconds(F.col("timestamp_local"), F.lag("timestamp_local").over(W.partitionBy("file").orderBy("timestamp_local"))))
    off = F.col("dt").isNotNull() & (F.col("dt") != F.col(interval))
    w = W.partitionBy("file", off).orderBy("timestamp_local")
    d = d.withColumn("off", off).withColumn("nth", F.row_number().over(w))
    return d.groupBy("file").agg(
        F.mode("dt", True).alias("usual_s"), F.count_if("off").alias("n_off"), F.count_if(F.col("dt") > F.col(interval)).alias("n_gaps"),
        F.array_sort(F.collect_list(F.when(F.col("off") & (F.col("nth") <= 3), F.col("timestamp_local")))).alias("first_off"),
    )


def events_check(rows: DataFrame, events: DataFrame) -> DataFrame:
    """First and last sample against the file's started and ended events, and its spacings against its setting."""
    d = rows.withColumn("dt", calendar.seconds(F.col("timestamp_local"), F.lag("timestamp_local").over(W.partitionBy("file").orderBy("timestamp_local"))))
    own = d.groupBy("file").agg(F.min("timestamp_local").alias("t0"), F.max("timestamp_local").alias("t1"), F.count_distinct("dt").alias("n_dt"), F.min("dt").alias("dt"))
    j = own.join(events, "file")
    ok = F.col("t0").eqNullSafe(F.col("started")) & F.col("t1").eqNullSafe(F.col("ended")) & (F.col("n_dt") <= 1) & F.coalesce(F.col("dt") == F.col("interval_s"), F.lit(True))
    return j.select(*check_row("events", ok))


def zone_check(spans: DataFrame, offsets: dict[str, float]) -> DataFrame:
    """A header's zone abbreviation against the registered zone at both ends of a file.

    It warns where there is no abbreviation, the zone is none that is known, the clocks
    change between, or the abbreviation is another one; it is skipped without a zone.
    """
    table = F.create_map(*[F.lit(x) for k, v in offsets.items() for x in (k, float(v))])
    known = F.when(F.col("zone").isin(*sorted(zoneinfo.available_timezones())), F.col("zone"))
    hours = lambda c: calendar.seconds(F.col(c), F.to_utc_timestamp(F.col(c), F.coalesce(known, F.lit("UTC")))) / 3600
    a, b, want = hours("first_local"), hours("last_local"), F.try_element_at(table, F.col("token"))
    agrees = F.coalesce(known.isNotNull() & (a == b) & (a == want), F.lit(False))
    status = F.when(F.col("token").isNull(), "warn").when(F.col("zone").isNull(), "skipped").when(agrees, "pass").otherwise("warn")
    return spans.select("file", F.lit(LOGGER_ZONE).alias("check"), status.alias("status"), F.col("token").alias("detail"))


def first_values(df: DataFrame, key: str, value: str, k: int = 5) -> DataFrame:
    """The first k different values of each key, for a report; found by a ranked window, not by gathering all."""
    d = df.select(key, value).distinct().filter(F.col(value).isNotNull())
    r = d.withColumn("rn", F.row_number().over(W.partitionBy(key).orderBy(value))).filter(F.col("rn") <= k)
    return r.groupBy(key).agg(F.array_sort(F.collect_list(value)).alias("examples"))


def unknown_parameters(declared: DataFrame, vocabulary: list[str]) -> DataFrame:
    return declared.filter(~F.col("parameter").isin(*vocabulary))


def outcome(checks: DataFrame, order: list[str]) -> DataFrame:
    """For each file the first failing check by order; such a file is quarantined."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col("check"))
    bad = checks.filter("status = 'fail'").groupBy("file").agg(F.min_by("check", place).alias("blocked_by"))
    return checks.select("file").distinct().join(bad, "file", "left").withColumn("outcome", F.when(F.col("blocked_by").isNull(), "accepted").otherwise("quarantined"))


def rows_in_out(rows_in: DataFrame, rows_out: DataFrame) -> DataFrame:
    """Rows a file holds and gives: none from some is a failure, none from none a gap."""
    a, b = rows_in.groupBy("file").agg(F.count("line").alias("n_in")), rows_out.groupBy("file").agg(F.count("*").alias("n_out"))
    n = F.coalesce("n_out", F.lit(0))
    return a.join(b, "file", "left").select(
        "file", "n_in", n.alias("n_out"), F.when((F.col("n_in") > 0) & (n == 0), "failure").when(F.col("n_in") == 0, "gap").otherwise("ok").alias("outcome")
    )


# --- gates over the registry --------------------------------------------------------------------


def match_site(files: DataFrame, sites: DataFrame, tolerance: float = 0.0005) -> DataFrame:
    """The one site at a file's position; none or several quarantine it.

    Positions are first met on a grid of the tolerance's size and its neighbours, so the
    join has an equality and no product is made.
    """
    cell = 2 * tolerance
    s = sites.select("site_id", F.col("lat").alias("slat"), F.col("lon").alias("slon"))
    around = F.array(F.lit(-1), F.lit(0), F.lit(1))
    s = s.withColumn("i", F.explode(F.transform(around, lambda k: F.floor(F.col("slat") / cell) + k))).withColumn("j", F.explode(F.transform(around, lambda k: F.floor(F.col("slon") / cell) + k)))
    f = files.withColumn("i", F.floor(F.col("lat") / cell)).withColumn("j", F.floor(F.col("lon") / cell))
    hits = f.join(s, ["i", "j"]).filter(position_matches(F.col("lat"), F.col("lon"), F.col("slat"), F.col("slon"), tolerance))
    one = hits.groupBy("file").agg(F.count("*").alias("n"), F.min("site_id").alias("site_id"))
    return files.join(one, "file", "left").select(
        "file", F.when(F.col("n") == 1, F.col("site_id")).alias("site_id"),
        F.when(F.col("n") == 1, "accepted").otherwise("quarantined").alias("outcome"), F.coalesce("n", F.lit(0)).alias("n_sites"),
    )


def registry_gate(files: DataFrame, deployments: DataFrame) -> DataFrame:
    """The deployment of a file's serial: one complete candidate, or the one of its number, else quarantine."""
    complete = deployments.filter("w_start is not null and w_end is not null").select("serial", "deployment_number").distinct()
    c = files.join(complete.withColumnRenamed("deployment_number", "number"), "serial", "left")
    c = c.withColumn("n", F.count("number").over(W.partitionBy("file")))
    chosen = c.filter((F.col("n") == 1) | (F.col("number") == F.col("file_number"))).groupBy("file").agg(F.min("number").alias("deployment_number"))
    return files.join(chosen, "file", "left").select(
        "file", "serial", "deployment_number", F.when(F.col("deployment_number").isNull(), "quarantined").otherwise("accepted").alias("outcome")
    )


def series_map_gate(series: DataFrame, mapping: DataFrame) -> DataFrame:
    """Whether a file's series are all, partly or not at all mapped to parameters."""
    j = series.join(mapping, ["serial", "series"], "left")
    n, m = F.count("*"), F.count("parameter")
    return j.groupBy("file").agg(n.alias("n_series"), m.alias("n_mapped"), F.when(m == 0, "fail").when(m < n, "warn").otherwise("pass").alias("status"))


def dataset_owner(years: DataFrame, datasets: DataFrame) -> DataFrame:
    """The dataset of a station that owns a year; a dataset opens where the one before it ends.

    ``datasets`` has station, dataset, ends_at (null: open) in years.
    """
    w = W.partitionBy("station").orderBy(F.col("ends_at").asc_nulls_last())
    d = datasets.withColumn("opens_at", F.coalesce(F.lag("ends_at").over(w), F.lit(-9999)))
    return years.join(d, "station").filter((F.col("year") >= F.col("opens_at")) & (F.col("ends_at").isNull() | (F.col("year") < F.col("ends_at")))).select("station", "year", "dataset")


def canopy_file_polygon(files: DataFrame, polygons: DataFrame) -> DataFrame:
    """The one polygon whose declaration names a file; none or several quarantine it."""
    once = polygons.groupBy("file").agg(F.count("*").alias("n")).filter("n = 1")
    return files.join(polygons.join(once, "file", "left_semi"), "file", "left").withColumn("outcome", F.when(F.col("polygon_id").isNull(), "quarantined").otherwise("accepted"))


def repeated_landings(files: DataFrame) -> DataFrame:
    """Polygons with several landed files at one revision."""
    return files.groupBy("polygon_id", "revision").agg(F.count_distinct("file").alias("n_files")).filter("n_files > 1")


def public_stations(sites: DataFrame, operator: str) -> DataFrame:
    """Stations of an operator that have a code or earlier datasets, one row for each neighbour reference."""
    return sites.filter((F.col("operator") == operator) & (F.col("code").isNotNull() | (F.size("datasets") > 0))).select(
        "site_id", "code", F.explode_outer("neighbor_refs").alias("ref")
    )
