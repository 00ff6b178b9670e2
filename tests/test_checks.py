"""Assertions over files and registries on small frames."""

import datetime as dt
import itertools
import json

import pytest

from pyspark.sql import functions as F

from driftline.functions import fields, verdicts
from driftline.operators import checks, screen, validation
from driftline.sources import config, text, zones

T0 = dt.datetime(2024, 7, 1)


def status(df):
    return {r.file: r.status for r in df.collect()}


def test_declared_units_and_longitudes(spark):
    headers = spark.createDataFrame([("a", "z", "m"), ("a", "temp", "K"), ("b", "temp", None), ("b", "other", "x")], "file string, column string, unit string")
    assert {(r.file, r.column, r.expected) for r in checks.units(headers, {"z": "m", "temp": "degC"}).collect()} == {("a", "temp", "degC"), ("b", "temp", "degC")}
    rows = spark.createDataFrame([("a", 117.0), ("a", 117.2), ("b", 117.0), ("b", -117.0)], "file string, longitude double")
    assert status(checks.longitude_sign(rows)) == {"a": "pass", "b": "fail"}


def test_grid_step_takes_the_median_of_different_lines(spark):
    fine = [("a", 33 + 0.01 * i) for i in range(6) for _ in range(2)]
    rows = spark.createDataFrame([*fine, *(("b", 33 + 0.02 * i) for i in range(6)), ("c", 33.0)], "file string, latitude double")
    assert status(checks.grid_step(rows, "latitude")) == {"a": "pass", "b": "fail", "c": "fail"}


def test_signs_of_an_edited_file(spark):
    rows = spark.createDataFrame([("a", 1, 1, T0), ("a", 2, 2, T0), ("b", 1, 1, T0), ("b", 2, 3, None)], "file string, line_no long, row_number long, timestamp_local timestamp_ntz")
    extra = spark.createDataFrame([("b", 1)], "file string, n_extra int")
    assert {r.file: r.signs for r in checks.edited_file(rows, extra).collect()} == {"a": [], "b": ["extra columns", "rows without time", "broken counter"]}


def test_serials_and_reported_statistics(spark):
    files = spark.createDataFrame([("a", "1", "1"), ("b", "1", "2"), ("c", None, "2")], "file string, file_serial string, recorded_serial string")
    assert status(checks.serials(files)) == {"a": "pass", "b": "warn", "c": "pass"}
    rows = spark.createDataFrame([("a", "t", 1.0), ("a", "t", 2.0), ("a", "t", None), ("b", "t", 1.0)], "file string, series string, value double")
    said = spark.createDataFrame([("a", "t", 2, 1.0, 2.0, 1.5), ("b", "t", 1, 1.0, 1.0, 1.01), ("c", "t", 0, None, None, None)], "file string, series string, rep_n long, rep_min double, rep_max double, rep_mean double")
    assert status(checks.statistics_check(rows, said)) == {"a": "pass", "b": "fail", "c": "fail"}


def test_a_mean_halfway_between_two_places_does_not_follow_the_order_of_rows(spark):
    values = [0.07, 0.1, 0.1, 0.03, 5.0, 3.13]
    value = "file string, series string, place long, value double"
    orders = {f"o{i}": v for i, v in enumerate(itertools.permutations(values))}
    rows = spark.createDataFrame([(f, "t", i, x) for f, v in orders.items() for i, x in enumerate(v)], value).coalesce(1)
    # 8.43 of six is 1.405, halfway
    said = spark.createDataFrame([(f, "t", 6, 0.03, 5.0, 1.405) for f in orders], "file string, series string, rep_n long, rep_min double, rep_max double, rep_mean double")
    assert set(status(checks.statistics_check(rows, said)).values()) == {"pass"}


def test_events_and_cadence(spark):
    step = dt.timedelta(minutes=10)
    rows = spark.createDataFrame([(f, T0 + step * i) for f in "ab" for i in range(3)] + [("b", T0 + step * 9)], "file string, timestamp_local timestamp_ntz")
    events = spark.createDataFrame([(f, T0, T0 + step * n, 600.0) for f, n in (("a", 2), ("b", 9))], "file string, started timestamp_ntz, ended timestamp_ntz, interval_s double")
    assert status(checks.events_check(rows, events)) == {"a": "pass", "b": "fail"}
    got = {r.file: (r.usual_s, r.n_off, r.n_gaps, r.first_off) for r in checks.cadence_audit(rows.withColumn("interval_s", F.lit(600.0))).collect()}
    assert got == {"a": (600.0, 0, 0, []), "b": (600.0, 1, 1, [T0 + step * 9])}


def test_zone_tokens_and_a_change_of_clocks(spark):
    w, s = dt.datetime(2024, 1, 5), dt.datetime(2024, 7, 5)
    spans = spark.createDataFrame([("a", "PDT", s, s), ("b", "PST", s, s), ("c", "PST", w, s), ("d", "EST", s, s)], "file string, token string, first_local timestamp_ntz, last_local timestamp_ntz")
    found = checks.zone_check(spans.withColumn("zone", F.lit("America/Los_Angeles")), {"PDT": -7, "PST": -8})
    assert status(found) == {"a": "pass", "b": "warn", "c": "warn", "d": "warn"}
    odd = spark.createDataFrame([("e", None, "America/Los_Angeles"), ("f", "PDT", None), ("g", "PDT", "Nowhere/City")], "file string, token string, zone string")
    odd = odd.withColumn("first_local", F.lit(s).cast("timestamp_ntz")).withColumn("last_local", F.lit(s).cast("timestamp_ntz"))
    assert status(checks.zone_check(odd, {"PDT": -7})) == {"e": "warn", "f": "skipped", "g": "warn"}


def test_rows_in_and_out(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", None)], "file string, line long")
    out = spark.createDataFrame([("a",)], "file string")
    assert {r.file: (r.n_in, r.n_out, r.outcome) for r in checks.rows_in_out(rows, out).collect()} == {"a": (2, 1, "ok"), "b": (1, 0, "failure"), "c": (0, 0, "gap")}


def test_series_maps_and_canopy_files(spark):
    series = spark.createDataFrame([("a", "s", "x"), ("a", "s", "y"), ("b", "s", "x"), ("c", "s", "z")], "file string, serial string, series string")
    mapping = spark.createDataFrame([("s", "x", "temp")], "serial string, series string, parameter string")
    assert status(checks.series_map_gate(series, mapping)) == {"a": "warn", "b": "pass", "c": "fail"}
    files = spark.createDataFrame([("p.csv",), ("q.csv",), ("r.csv",)], "file string")
    polygons = spark.createDataFrame([("p.csv", "P"), ("r.csv", "P"), ("r.csv", "Q")], "file string, polygon_id string")
    found = {r.file: r.outcome for r in checks.canopy_file_polygon(files, polygons).collect()}
    assert found == {"p.csv": "accepted", "q.csv": "quarantined", "r.csv": "quarantined"}
    landed = spark.createDataFrame([("P", 1, "a"), ("P", 1, "b"), ("P", 2, "c")], "polygon_id string, revision int, file string")
    assert [tuple(r) for r in checks.repeated_landings(landed).collect()] == [("P", 1, 2)]


def test_public_stations(spark):
    sites = spark.createDataFrame(
        [("A", "op", "1", [], ["r1", "r2"]), ("B", "op", None, ["old"], None), ("C", "op", None, [], ["r"]), ("D", "other", "2", [], ["r"])],
        "site_id string, operator string, code string, datasets array<string>, neighbor_refs array<string>",
    )
    assert {(r.site_id, r.ref) for r in checks.public_stations(sites, "op").collect()} == {("A", "r1"), ("A", "r2"), ("B", None)}


def test_observation_faults(spark):
    row = (T0, "A", "temp", 1.0, 1.0, 2, "", "s", "r")
    good = spark.createDataFrame([row], zones.OBSERVATION)
    assert checks.observation_faults(good, good.schema) == {}
    bad = spark.createDataFrame([(*row[:5], 7, *row[6:]), (*row[:3], float("nan"), *row[4:])], zones.OBSERVATION)
    assert checks.observation_faults(bad, good.schema) == {"qc_flag": 1, "nan": 1}
    assert checks.observation_faults(good.select("value", "qc_flag"), good.schema)["schema"] == 1


def test_examples_notes_and_places(spark):
    df = spark.createDataFrame([("k", i % 7) for i in range(20)] + [("k", None)], "k string, x int")
    assert checks.first_values(df, "k", "x").first().examples == [0, 1, 2, 3, 4]
    audit = spark.createDataFrame([("s", "mean", "ok"), ("s", "max", "excluded")], "source string, feature string, verdict string")
    assert screen.audit_note(audit, "max").count() == 1 and screen.audit_note(audit, "mean").count() == 0
    cells = spark.createDataFrame([(0.9, 0.9, 20.0, "p"), (-0.9, -0.9, 20.0, "p"), (0.1, 0.1, 40.0, "p")], "r double, rho double, n_eff double, role string")
    assert sorted((r.r, r.abs_r_rank, r.z_rank) for r in screen.scale_ranks(cells).collect()) == [(-0.9, 1, 1), (0.1, 3, 3), (0.9, 1, 1)]


def test_breaks_and_standardised_values(spark):
    df = spark.createDataFrame([("k", 1, 2.0), ("k", 2, 2.0), ("k", 5, 2.0), ("m", 1, 1.0), ("m", 2, 3.0)], "k string, q int, x double")
    assert [(r.k, r.q) for r in validation.breaks(df, ["k"], "q", 1).filter("breaks").collect()] == [("k", 5)]
    z = {(r.k, r.q): round(r.x_z, 4) for r in validation.standardised(df, ["k"], "x").collect()}
    assert z == {("k", 1): 0.0, ("k", 2): 0.0, ("k", 5): 0.0, ("m", 1): -0.7071, ("m", 2): 0.7071}


# --- refusals, shore archives and logger files ---------------------------------------------------------


def refuses(df):
    with pytest.raises(Exception, match="refused|unknown flag code|USER_RAISED"):
        df.collect()


def test_what_cannot_be_right_is_refused(spark, tmp_path):
    one = spark.range(1)
    assert one.select(fields.depth_of_altitude(F.lit(-3.0)).alias("d")).first().d == 3.0
    assert one.select(fields.depth_of_altitude(F.lit(None).cast("double")).alias("d")).first().d is None
    refuses(one.select(fields.depth_of_altitude(F.lit(1.5))))
    assert one.select(verdicts.source_code_status(F.lit(3)).alias("s")).first().s == "suspect"
    refuses(one.select(verdicts.source_code_status(F.lit(7))))
    refuses(screen.with_roles(spark.createDataFrame([("t",)], "parameter string"), {"u": "control"}))
    head = "year,quarter,kelp_area_m2,count_cells_kelp,count_cells_no_clouds,count_cells_historic_footprint\n"
    for name, quarters, n in (("good", "1 max 2", 2), ("bad", "1 Q9", None)):
        (tmp_path / name).mkdir()
        (tmp_path / name / f"{name}.csv").write_text(head + "".join(f"2001,{q},900,1,2,3\n" for q in quarters.split()))
        rows = text.canopy(spark, str(tmp_path / name), spark.createDataFrame([(f"{name}.csv", "P")], "file string, polygon_id string"))
        refuses(rows) if n is None else None
        assert n is None or rows.count() == n


@pytest.mark.parametrize("lines", ["2001,2,,1030,0,15.0,0,14.0,0", "2001,2,30,1030,0,15.0,0,14.0,0", "2001,2,3,2570,0,15.0,0,14.0,0", "2001,2,3,,,15.0,0,,\n2001,2,3,,,15.1,0,,", "2001,2,3,,,15.0,8,,"])
def test_shore_days_and_codes_that_are_none_are_refused(spark, tmp_path, lines):
    head = "Station: X\nYEAR,MONTH,DAY,TIME_PST,TIME_FLAG,SURF_TEMP_C,SURF_FLAG,BOT_TEMP_C,BOT_FLAG,,\n"
    (tmp_path / "a.csv").write_text(head + "2001,1,1,,,14.0,0,13.0,0,,\n,,,,,,,,,,\n" + lines + "\n")
    refuses(text.shore_archive(spark, str(tmp_path), 0.0, 5.0, "X"))
    (tmp_path / "a.csv").write_text(head + "2001,1,1,,,14.0,0,13.0,0,,\n,,,,,,,,,,\n")
    assert text.shore_archive(spark, str(tmp_path), 0.0, 5.0, "X").count() == 2


def test_shore_pins_block_in_their_order(spark):
    day, legend = dt.date(2024, 1, 1), {"0": "good", "5": "bad"}
    schema = "file string, latitude double, longitude double, surface_m double, bottom_m double, archive_date date, legend map<string,string>"
    heads = spark.createDataFrame([("a", 32.9, -117.2, 0.0, 5.0, day, legend), ("b", 32.9, -117.2, 0.0, 4.0, day, {"0": "good"}), ("c", 32.9, -117.2, 0.0, 5.0, dt.date(2024, 2, 1), legend), ("d", 0.0, 0.0, 0.0, 5.0, day, legend)], schema)
    pins = heads.filter("file = 'a'").toDF("x", "site_lat", "site_lon", "site_surface_m", "site_bottom_m", "site_archive_date", "site_legend").drop("x")
    pins = pins.crossJoin(spark.createDataFrame([(x,) for x in "abc"], "file string"))
    rows = checks.shore_pins(heads, pins)
    got = {(r.file, r.check): r.status for r in rows.collect()}
    assert all(got["a", c] == "pass" for c in checks.SHORE_ORDER) and got["c", "archive date"] == "warn"
    out = {r.file: (r.outcome, r.blocked_by) for r in checks.outcome(rows, checks.SHORE_ORDER).collect()}
    assert out == {"a": ("accepted", None), "b": ("quarantined", "legend"), "c": ("accepted", None), "d": ("quarantined", "position")}


def test_all_checks_of_a_logger_file(spark):
    step = dt.timedelta(minutes=10)
    rows = spark.createDataFrame([(f, i + 1, i + 1, T0 + step * i, "t", float(i)) for f in "ab" for i in range(3)], "file string, line_no long, row_number long, timestamp_local timestamp_ntz, series string, value double")
    extra = spark.createDataFrame([("b", 2)], "file string, n_extra int")
    files = spark.createDataFrame([("a", "1", "1"), ("b", "1", "2")], "file string, file_serial string, recorded_serial string")
    events = spark.createDataFrame([(f, T0, T0 + step * 2, 600.0) for f in "ab"], "file string, started timestamp_ntz, ended timestamp_ntz, interval_s double")
    said = spark.createDataFrame([(f, "t", 3, 0.0, 2.0, 1.0) for f in "ab"], "file string, series string, rep_n long, rep_min double, rep_max double, rep_mean double")
    spans = spark.createDataFrame([(f, "PDT", T0, T0, "America/Los_Angeles") for f in "ab"], "file string, token string, first_local timestamp_ntz, last_local timestamp_ntz, zone string")
    files = files.withColumn("file_number", F.lit(None).cast("long"))
    deployed = spark.createDataFrame([("1", 1, T0, T0), ("2", 1, T0, T0)], "serial string, deployment_number long, w_start timestamp_ntz, w_end timestamp_ntz")
    mapping = spark.createDataFrame([("1", "t", "temp"), ("2", "t", "temp")], "serial string, series string, parameter string")
    found = checks.logger_checks(rows, extra, files, events, said, spans, {"PDT": -7}, deployed, mapping)
    assert {c for c, in found.select("check").distinct().collect()} == set(checks.LOGGER_ORDER)
    # an edited and renamed file is recorded as such and ingested
    assert {(r.check, r.status) for r in found.filter("file = 'b' and status <> 'pass'").collect()} == {("edited", "fail"), ("serial", "warn")}
    assert {r.file: r.blocked_by for r in checks.logger_outcome(found).collect()} == {"a": None, "b": None}
    assert {r.file: r.blocked_by for r in checks.logger_outcome(checks.logger_checks(rows, extra, files, events, said, spans, {"PDT": -8}, deployed, mapping)).collect()} == {"a": "time zone", "b": "time zone"}
    no_map = checks.logger_checks(rows, extra, files, events, said, spans, {"PDT": -8}, deployed, mapping.filter("serial = '1'"))
    assert {r.file: r.blocked_by for r in checks.logger_outcome(no_map).collect()} == {"a": "time zone", "b": "series map"}
    nothing = checks.logger_checks(rows, extra, files, events, said, spans, {"PDT": -7}, deployed.filter("serial = '1'"), mapping.limit(0))
    assert {r.file: r.blocked_by for r in checks.logger_outcome(nothing).collect()} == {"a": "series map", "b": "registry gate"}


def test_first_days_with_a_source_flag(spark):
    rows = spark.createDataFrame([("a", "s", T0 + dt.timedelta(days=i), 1.0, 5 if i % 2 else 0) for i in range(16)] + [("a", "s", T0, None, 5)], "file string, series string, timestamp timestamp_ntz, value double, flag int")
    r = checks.first_flagged(rows).first()
    assert r.n_days == 8 and r.first_days == [(T0 + dt.timedelta(days=d)).date() for d in (1, 3, 5, 7, 9)]


def test_declared_settings(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"_comment": "x", "parameters": {"t": {"unit": "degC", "valid_range": [0, 40], "qc": {"spike": {"suspect": 1, "fail": 2}, "by_source": {"s": {"spike": None, "rate_of_change": {"suspect_per_hour": 3, "fail_per_hour": 6}}}}}, "w": {"unit": "m"}}}))
    p = {r.parameter: r for r in config.parameters(spark, str(tmp_path / "p.json")).collect()}
    assert (p["t"].valid_max, p["t"].spike_fail, p["t"].rate_fail, p["w"].valid_min) == (40.0, 2.0, None, None)
    by = {(r.parameter, r.source, r.test): (r.suppressed, r.suspect, r.fail) for r in config.source_exceptions(spark, str(tmp_path / "p.json")).collect()}
    assert by == {("t", "s", "spike"): (True, None, None), ("t", "s", "rate_of_change"): (False, 3.0, 6.0)}
    (tmp_path / "f.json").write_text(json.dumps({"policy": {"coverage_floor": 0.6, "baseline": {"start_year": 2007, "end_year": 2019, "min_years": 10}, "baseline_overrides": {"_comment": "x", "A": {"start_year": 2015, "end_year": 2024}}}, "parameters": {"t": {"feature_set": "temperature", "thresholds": {"days_above_c": [20, 23], "time_in_band_c": [[14, 18]]}}, "w": {"feature_set": "statistics", "role": "control"}}}))
    f = str(tmp_path / "f.json")
    assert config.feature_policy(spark, f).first().start_year == 2007
    assert [(r.series, r.start_year, r.end_year) for r in config.baseline_overrides(spark, f).collect()] == [("A", 2015, 2024)]
    assert {r.parameter: r.role for r in config.feature_sets(spark, f).collect()} == {"t": "predictor", "w": "control"}
    assert {(r.parameter, r.kind, tuple(r.bounds)) for r in config.thresholds(spark, f).collect()} == {("t", "days_above_c", (20.0,)), ("t", "days_above_c", (23.0,)), ("t", "time_in_band_c", (14.0, 18.0))}
    (tmp_path / "g.json").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"polygon_id": "P", "purpose": "control", "site_ids": ["a", "b"], "source_file": "k.csv"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}]}))
    g = config.polygons(spark, str(tmp_path / "g.json"))
    assert [(r.polygon_id, r.purpose, r.file, len(r.outline)) for r in g.collect()] == [("P", "control", "k.csv", 4)]
    assert {(r.polygon_id, r.site_id) for r in config.polygon_sites(g).collect()} == {("P", "a"), ("P", "b")}


def test_profiles_meet_the_registry_without_a_shuffle_by_site(spark, tmp_path):
    (tmp_path / "a_2024-1.csv").write_text(",".join(text.PROFILE_COLUMNS) + "\nUTC,d,d,m,C,1,1\n2024-01-01T00:00:00Z,32,-117,-5.0,14.5,1,11111111111\n")
    declared = spark.createDataFrame([("a", 5.0)], "site_id string, depth_m double")
    rows = text.moored_profile(spark, str(tmp_path), declared)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
    assert [(r.site_id, r.depth_m, r.value, r.qc_flag) for r in rows.collect()] == [("a", 5.0, 14.5, 1)]


def test_a_long_year_of_one_site_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(zones, "FILE_ROWS", 100, raising=False)
    at = F.timestamp_seconds(F.lit(1720000000) + F.col("id") * 60).cast("timestamp_ntz")
    rows = spark.range(1000).select(
        at.alias("timestamp"), F.lit("S").alias("site_id"), F.lit("t").alias("parameter"), F.col("id").cast("double").alias("value"), F.lit(1.0).alias("depth_m"),
        F.lit(2).cast("tinyint").alias("qc_flag"), F.lit("").alias("qc_tests"), F.lit("s").alias("source"), F.lit("run-0").alias("fetch_run_id"),
    )
    zones.write_observations(rows, str(tmp_path / "o"))
    sizes = [r["count"] for r in zones.read_observations(spark, str(tmp_path / "o")).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 1000 and len(sizes) > 1 and max(sizes) < 600
