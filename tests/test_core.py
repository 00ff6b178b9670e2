"""Rules of the observation engine on small frames."""

import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from driftline.functions import calendar, fields, naming, stats, verdicts
from driftline.operators import checks, features, grid, quality, screen, selection, slices, validation
from driftline.operators.watch import Watch
from driftline.operators.windowed import reduce_windows
from driftline.sources import headed, snapshots, text, zones

T0 = dt.datetime(2024, 1, 1)
PARAMETERS = {"temp": {"valid_range": (5.0, 35.0), "spike": (1.5, 3.0), "rate_per_hour": (18.0, 36.0)}}
WARM = {"temp": {"days_above": (20.0,), "max_spell_above": (20.0,), "time_in_band": ((14.0, 20.0),)}}


def obs(spark, values, minutes=10, depth=1.0, start=T0, tests="", source="s", run="r0", site="A"):
    rows = [(start + dt.timedelta(minutes=minutes * i), site, "temp", v, depth, 9 if v is None else 2, tests, source, run) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, zones.OBSERVATION)


def flags(df):
    return [r.qc_flag for r in df.orderBy("timestamp").collect()]


# --- quality -----------------------------------------------------------------------------------


def test_neighbours_of_a_spike_are_judged_and_ends_are_not(spark):
    out = quality.evaluate(obs(spark, [15.0, 15.0, 20.0, 15.0, 15.0]), PARAMETERS).orderBy("timestamp").collect()
    assert [r.qc_flag for r in out] == [1, 3, 4, 3, 1]
    assert out[0].qc_tests == "gross_range:pass" and "spike:fail" in out[2].qc_tests


def test_gaps_are_never_bridged(spark):
    out = quality.evaluate(obs(spark, [15.0, None, 15.0, 15.0]), PARAMETERS).orderBy("timestamp").collect()
    assert [r.qc_flag for r in out] == [1, 9, 1, 1]
    assert out[1].qc_tests == "gross_range:missing;spike:missing;rate_of_change:missing"
    assert out[2].qc_tests == "gross_range:pass"


def test_evaluation_is_idempotent_and_keeps_foreign_verdicts(spark):
    once = quality.evaluate(obs(spark, [15.0, 40.0, 15.0], tests="deployment_window:fail;spike:pass"), PARAMETERS)
    twice = quality.evaluate(once, PARAMETERS)
    assert once.orderBy("timestamp").collect() == twice.orderBy("timestamp").collect()
    assert flags(once) == [4, 4, 4] and all(r.qc_tests.startswith("deployment_window:fail;") for r in once.collect())


def test_unreadable_verdicts_are_refused_and_the_last_of_a_name_counts(spark):
    for bad in ("deployment_window", "spike:probably", "spike: pass", ":pass", "a:pass:fail"):
        with pytest.raises(Exception, match="unreadable verdicts"):
            quality.evaluate(obs(spark, [15.0], tests=bad), PARAMETERS).collect()
        assert quality.evaluate(obs(spark, [15.0], tests=bad), {}).first().qc_tests == bad  # not judged, not touched
    row = quality.evaluate(obs(spark, [15.0], tests=" a:fail ;; a:suspect;\tb:pass"), PARAMETERS).first()
    assert (row.qc_flag, row.qc_tests) == (3, "gross_range:pass;a:suspect;b:pass")


@pytest.mark.parametrize("width", ["month", "minute", "second"])
def test_slices_cut_between_every_pair_of_rows_change_nothing(spark, width):
    r = __import__("random").Random(3)
    rows = []
    for site in range(4):  # with gaps, runs of one row to a slice, repeated times, and series of one and two rows
        t = T0 - dt.timedelta(days=2)
        for i in range([300, 40, 2, 1][site]):
            t += dt.timedelta(seconds=r.choice([0, 1, 1, 20, 600, 86400 * 3]))
            rows.append((t, f"S{site}", "temp", r.choice([None, 15.0, 15.5, 16.0, 22.0, 50.0]), r.choice([1.0]) if site else None, 2, "", "s", f"r{i % 3}"))
    df = spark.createDataFrame(rows, zones.OBSERVATION).repartition(5)
    order = ["site_id", "timestamp", "fetch_run_id", "value"]
    found = slices.with_neighbours(df, quality.SERIES, ["timestamp", "fetch_run_id"], ["value"], width).orderBy(*order).collect()
    plain = sorted(rows, key=lambda x: (x[1], x[0], x[8], x[3] is not None, x[3] or 0))
    assert len(found) == len(plain)
    for i, (a, b) in enumerate(zip(found, plain)):
        assert (a.site_id, a.timestamp, a.fetch_run_id, a.value) == (b[1], b[0], b[8], b[3])
        for side, j in ((a["__before"], i - 1), (a["__after"], i + 1)):
            want = plain[j] if 0 <= j < len(plain) and plain[j][1] == b[1] else None
            assert (side and (side.timestamp, side.fetch_run_id, side.value)) == (want and (want[0], want[8], want[3]))
        assert a["__n"] == [300, 40, 2, 1][int(b[1][1])]
    whole, cut = (sorted(map(str, quality.evaluate(df, PARAMETERS, w).collect())) for w in ("year", width))
    assert whole == cut and len(cut) == len(rows)
    with pytest.raises(ValueError, match="spans"):
        slices.with_neighbours(df, quality.SERIES, ["timestamp"], [], "century")


def test_a_hot_series_is_dealt_to_many_tasks(spark):
    df = spark.range(40_000).selectExpr(
        "timestamp_ntz'2020-01-01' + make_dt_interval(0, 0, 0, id * 3000) AS timestamp", "'A' AS site_id", "'temp' AS parameter", "15D AS value",
        "1D AS depth_m", "2Y AS qc_flag", "'' AS qc_tests", "'s' AS source", "'r' AS fetch_run_id",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        flagged = quality.evaluate(df, PARAMETERS).withColumn("task", F.spark_partition_id())
        sizes = [r.n for r in flagged.groupBy("task").agg(F.count("*").alias("n"), F.max("qc_tests")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 40_000 and len(sizes) > 8 and max(sizes) < 8_000


def test_unknown_parameters_and_series_over_a_year_end(spark):
    df = obs(spark, [15.0, 15.0, 30.0, 15.0], start=dt.datetime(2023, 12, 31, 23, 45))
    assert flags(quality.evaluate(df, PARAMETERS))[2] == 4
    assert quality.evaluate(df, {}).select("qc_flag").distinct().collect()[0][0] == 2


def test_verdict_text(spark):
    df = spark.createDataFrame([("b:fail;spike:pass;a:suspect",), ("",), (None,), ("x:odd",)], "t string")
    got = df.select(verdicts.describe(verdicts.parse("t") if False else verdicts.parse(F.col("t"))).alias("d"), verdicts.rollup(F.map_values(verdicts.parse(F.col("t")))).alias("f"), verdicts.malformed(F.col("t")).alias("m")).collect()
    assert [tuple(r) for r in got] == [("spike:pass;a:suspect;b:fail", 4, False), ("", 2, False), ("", 2, False), ("x:odd", 2, True)]
    names = ("p", "q", "r")
    d = spark.createDataFrame([("134",), ("12",), ("229",)], "d string").select(verdicts.describe(verdicts.decode_digits(F.col("d"), names)).alias("x")).collect()
    assert [r.x for r in d] == ["p:pass;q:suspect;r:fail", "", "r:missing"]


# --- windows -----------------------------------------------------------------------------------


def window(spark, days, values, start, end, closed):
    rows = [(dt.datetime(2026, 7, d, 12), "temp", v, 2, v is not None, start, end) for d, v in zip(days, values)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, parameter string, value double, qc_flag int, keep boolean, w_start timestamp_ntz, w_end timestamp_ntz")
    return reduce_windows(df, ["parameter"], WARM, 0.6, closed=closed).first()


def test_spell_at_the_window_edge_is_a_measurement_and_at_a_gap_a_floor(spark):
    w = lambda d, h: dt.datetime(2026, 7, d, h)
    five = range(11, 16)
    r = window(spark, five, [22.0] * 5, w(11, 8), w(15, 20), True)
    assert (r.max_spell_above_20c_days, r.max_spell_above_20c_gap_interrupted) == (5.0, False)
    r = window(spark, five, [22.0] * 5, dt.datetime(2026, 7, 1), dt.datetime(2026, 10, 1), False)
    assert (r.max_spell_above_20c_days, r.max_spell_above_20c_gap_interrupted) == (5.0, True)
    r = window(spark, [11, 12, 13, 15, 16, 17], [22.0] * 6, w(11, 0), w(17, 23), True)
    assert (r.max_spell_above_20c_days, r.max_spell_above_20c_gap_interrupted) == (3.0, True)
    r = window(spark, [11, 12, 13, 14], [22.0] * 3 + [15.0], w(11, 0), w(14, 23), True)
    assert (r.max_spell_above_20c_days, r.max_spell_above_20c_gap_interrupted) == (3.0, False)


def test_closed_windows_expect_one_more_and_failed_windows_stay(spark):
    rows = [(T0 + dt.timedelta(minutes=10 * i), "temp", 15.0, 2, True, T0, T0 + dt.timedelta(hours=1)) for i in range(7)]
    schema = "timestamp timestamp_ntz, parameter string, value double, qc_flag int, keep boolean, w_start timestamp_ntz, w_end timestamp_ntz"
    df = spark.createDataFrame(rows, schema)
    r = reduce_windows(df, ["parameter"], WARM, 0.6, closed=True).first()
    assert (r.expected_obs, r.pct_coverage, r.usable, r.frac_in_band_14c_20c) == (7.0, 1.0, True, 1.0)
    r = reduce_windows(df.withColumn("keep", F.lit(False)), ["parameter"], WARM, 0.6).first()
    assert r.n_obs == 0 and r["mean"] is None and r.days_above_20c is None and r.max_spell_above_20c_days is None and r.usable is False


@pytest.mark.parametrize("bins", [4096, 2])
def test_counted_percentiles_equal_the_buffered_ones(spark, monkeypatch, bins):
    monkeypatch.setattr(selection, "BINS", bins)
    r = __import__("random").Random(4)
    kinds = {"flat": lambda: 7.0, "ties": lambda: r.choice([1.0, 2.0, 2.5]), "wide": lambda: r.choice([-1, 1]) * 10 ** r.uniform(-9, 9), "narrow": lambda: 15 + r.random() * 1e-9, None: lambda: r.gauss(0, 1)}
    rows = [(k, i % 3, f()) for k, f in kinds.items() for i in range(600)] + [("one", 1, 4.0), ("two", 1, 4.0), ("two", 1, None), ("two", 1, 5.0), ("none", 1, None)]
    df = spark.createDataFrame(rows, "k string, j long, x double").repartition(3)
    want = df.filter("x is not null").groupBy("k", "j").agg(F.percentile("x", [0.05, 0.5, 0.95, 0.0, 1.0]).alias("points"))
    got = selection.percentiles(df, ["k", "j"], "x", [0.05, 0.5, 0.95, 0.0, 1.0])
    assert sorted(map(str, got.select("k", "j", "points").collect())) == sorted(map(str, want.collect()))
    assert selection.percentiles(df.filter("x is null"), ["k", "j"], "x", [0.5]).count() == 0


@pytest.mark.parametrize("bound", [selection.BROADCAST_BINS, 0])
def test_windows_of_long_groups_are_the_same_counted(spark, monkeypatch, bound):
    monkeypatch.setattr(selection, "BROADCAST_BINS", bound)
    r = __import__("random").Random(5)
    df = obs(spark, [r.choice([None, 12.0, 15.5, 21.0, r.gauss(18, 4)]) for _ in range(700)], minutes=7, depth=None).unionByName(obs(spark, [20.0, 21.0], site="B"))
    rows = df.withColumn("keep", F.col("value").isNotNull()).withColumn("w_start", F.lit("2024-01-01").cast("timestamp_ntz")).withColumn("w_end", F.lit("2024-04-01").cast("timestamp_ntz"))
    held, counted = (reduce_windows(rows, quality.SERIES, WARM, 0.1, held=h).orderBy("site_id").collect() for h in (10**6, 100))
    assert held == counted and counted[0].p95 > counted[0].p05 and counted[0].cadence_s == 420.0


def test_names_follow_thresholds():
    assert naming.threshold_label(-1.0) == "neg1c" and naming.threshold_label(20.5) == "20p5c" and naming.band_label(14.0, 20.0) == "14c_20c"
    assert [c for c, _ in naming.feature_columns(WARM)][6:] == ["days_above_20c", "max_spell_above_20c_days", "max_spell_above_20c_gap_interrupted", "frac_in_band_14c_20c"]
    assert naming.anomaly_columns(["mean"]) == ["baseline_years", "mean_anom"]


def test_deployments_clip_days_and_refuse_overlaps(spark):
    d = spark.createDataFrame(
        [("A", "t1", 1, "temp", 1.0, dt.datetime(2024, 1, 1, 6), dt.datetime(2024, 1, 2, 18)), ("A", "t1", 2, "temp", 1.0, dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3))],
        "site_id string, serial string, deployment_number long, parameter string, depth_m double, w_start timestamp_ntz, w_end timestamp_ntz",
    )
    assert features.overlapping_deployments(d).count() == 1
    one = d.filter("deployment_number = 1")
    days = features.build_sub_windows(obs(spark, [15.0] * 72, minutes=60), one, WARM, 0.6, "day").orderBy("day").collect()
    assert [(r.n_obs, r.expected_obs, r.partial_day, r.pct_coverage) for r in days] == [(18, 18.0, True, 1.0), (19, 19.0, True, 1.0)]
    whole = features.build_deployment(obs(spark, [15.0] * 72, minutes=60), one, WARM, 0.6, "2024-02-01")
    audit = validation.grain_audit(whole, features.build_sub_windows(obs(spark, [15.0] * 72, minutes=60), one, WARM, 0.6, "day")).first()
    assert audit.counts_agree and audit.means_agree and whole.first().deployment_complete


def test_overlaps_equal_trying_all_pairs_and_disjoint_windows_meet_none(spark):
    r = __import__("random").Random(6)
    schema = "site_id string, serial string, deployment_number long, parameter string, depth_m double, w_start timestamp_ntz, w_end timestamp_ntz"
    at = lambda h: None if h is None else T0 + dt.timedelta(hours=h)
    rows = []
    for i in range(160):
        a = r.choice([None, *range(60)]) if i % 9 == 0 else r.randrange(60)
        rows.append((r.choice("AB"), f"s{i % 40}", i // 40, "temp", r.choice([None, 1.0]), at(a), at(a if a is None else a + r.choice([0, 1, 3, 20, -2]))))
    got = {(g.a_serial, g.a_deployment_number, g.b_serial, g.b_deployment_number) for g in features.overlapping_deployments(spark.createDataFrame(rows, schema)).collect()}
    whole = [x for x in rows if x[5] is not None and x[5] <= x[6]]
    want = {(x[1], x[2], y[1], y[2]) for x in whole for y in whole if (x[0], x[3], x[4]) == (y[0], y[3], y[4]) and x[1:3] < y[1:3] and x[5] <= y[6] and y[5] <= x[6]}
    assert got == want and len(got) > 100
    many = spark.range(10_000).selectExpr("'A' AS site_id", "cast(id AS string) AS serial", "1L AS deployment_number", "'temp' AS parameter", "1D AS depth_m", "timestamp_ntz'2000-01-01' + make_dt_interval(0, id * 2) AS w_start", "timestamp_ntz'2000-01-01' + make_dt_interval(0, id * 2 + 1) AS w_end")
    swept = features._overlaps(many, ["site_id"])
    assert swept.count() == 10_000 and swept.filter("__upto > __rank").count() == 0 and features.overlapping_deployments(many).count() == 0


def test_an_observation_meets_the_windows_of_its_month(spark):
    r = __import__("random").Random(7)
    times = [T0 + dt.timedelta(hours=r.randrange(0, 24 * 400)) for _ in range(300)]
    df = spark.createDataFrame([(t, r.choice("AB"), "temp", 1.0, r.choice([None, 1.0]), 2, "", "s", str(i)) for i, t in enumerate(times)], zones.OBSERVATION)
    windows = [(r.choice("AB"), f"s{i}", 1, "temp", r.choice([None, 1.0]), a, r.choice([a, a + dt.timedelta(hours=r.randrange(0, 3000))])) for i, a in enumerate(r.choices(times, k=40))] + [("A", "open", 1, "temp", 1.0, T0, None)]
    d = spark.createDataFrame(windows, "site_id string, serial string, deployment_number long, parameter string, depth_m double, w_start timestamp_ntz, w_end timestamp_ntz")
    got = sorted((x.fetch_run_id, x.serial) for x in features.deployment_rows(df, d).collect())
    assert got == sorted((o.fetch_run_id, w[1]) for o in df.collect() for w in windows if w[6] and (o.site_id, o.depth_m) == (w[0], w[4]) and w[5] <= o.timestamp <= w[6])


def test_platforms_fold_through_shared_kin(spark):
    refs = spark.createDataFrame([("A", "r1", 1), ("A", "r2", 2), ("A", "r3", 3), ("A", "r4", 4)], "site_id string, ref string, ordinal long")
    kin = spark.createDataFrame([("r3", "r1"), ("r3", "r4")], "a string, b string")
    folded = validation.fold_platforms(refs, kin)
    assert {r.ref: r.platform for r in folded.collect()} == {"r1": 1, "r2": 2, "r3": 1, "r4": 1}
    have = spark.createDataFrame([("r3", "t"), ("r4", "t"), ("r2", "t"), ("r1", "u")], "ref string, parameter string")
    chosen = {(r.parameter, r.ref, r.collapsed_refs) for r in validation.choose_references(folded, have).collect()}
    assert chosen == {("t", "r3", "r1;r4"), ("t", "r2", ""), ("u", "r1", "r3;r4")}


def test_long_chains_of_kin_fold_by_joins_in_few_rounds(spark, monkeypatch):
    rounds, plain = [], validation.written
    monkeypatch.setattr(validation, "written", lambda df, label: rounds.append(label) or plain(df, label))
    r = __import__("random").Random(8)
    chain = [(f"c{i:04d}", f"c{i + 1:04d}") for i in range(999)]
    others = [("x", "y"), ("y", "y"), ("z", "x"), ("m", "n")]
    pairs = [p if r.random() < 0.5 else p[::-1] for p in chain + others]
    r.shuffle(pairs)
    kin = spark.createDataFrame([*pairs, (None, "q")], "a string, b string")
    got = {x.ref: x.package for x in validation.components(kin.filter("a is not null")).collect()}
    assert got == {f"c{i:04d}": "c0000" for i in range(1000)} | {"x": "x", "y": "x", "z": "x", "m": "m", "n": "m"}
    assert rounds.count("parents") <= 14
    refs = spark.createDataFrame([("A", "z", 2), ("A", "y", 1), ("A", "lone", 3)], "site_id string, ref string, ordinal long")
    held, joined = (sorted(map(tuple, validation.fold_platforms(refs, kin.filter("a < 'c0' or a > 'd'"), h).collect())) for h in (10_000, 0))
    assert held == joined == [("A", "lone", 3, 3), ("A", "y", 1, 1), ("A", "z", 1, 2)]


# --- statistics -----------------------------------------------------------------------------------


def test_gram_blocks_and_lags_equal_plain_pearson(spark, monkeypatch):
    monkeypatch.setattr(screen, "GRAM", 3)
    monkeypatch.setattr(screen, "VECTORS", 2)
    r = __import__("random").Random(9)
    values = {}
    for k in range(11):
        for q in range(8000, 8060):
            if r.random() < 0.6:
                values[(f"s{k:02d}", q)] = 3.0 if k == 0 else r.gauss(1000 * k, 1) + (q % 7 if k % 2 else 0)
    rows = [("src", s, "temp", None, q // 4, q % 4 + 1, x) for (s, q), x in values.items()]
    df = spark.createDataFrame(rows, "source string, site_id string, parameter string, depth_m double, year int, quarter int, m double")
    names = sorted({s for s, _ in values})

    def pearson(xs):
        if len(xs) < 2:
            return None
        a, b = zip(*xs)
        ma, mb = sum(a) / len(a), sum(b) / len(b)
        va, vb = sum((x - ma) ** 2 for x in a), sum((x - mb) ** 2 for x in b)
        return None if (va * vb) ** 0.5 / len(a) <= 1e-12 else sum((x - ma) * (y - mb) for x, y in xs) / (va * vb) ** 0.5

    got = {(x.a.split("|")[1], x.b.split("|")[1]): (x.n_common, x.r and round(x.r, 8)) for x in screen.redundancy(df, "m").collect()}
    want = {}
    for a in names:
        for b in names:
            common = [(values[(a, q)], values[(b, q)]) for q in range(8000, 8060) if (a, q) in values and (b, q) in values]
            if a < b and common:
                p = pearson(common) if len(common) >= 8 else None
                want[(a, b)] = (len(common), p and round(p, 8))
    assert got == want and any(v[1] is None for v in want.values())
    s = spark.createDataFrame([(k, q, x) for (k, q), x in values.items()], "k string, q int, v double")
    found = {(x.k, x["k_lag"]): (x.n_pairs, x.r_k and round(x.r_k, 8)) for x in screen.autocorrelation(s.withColumnRenamed("k", "name"), ["name"], "v", [1, 4, 59, 90]).withColumnRenamed("k", "k_lag").withColumnRenamed("name", "k").collect()}
    want = {}
    for k in names:
        for lag in (1, 4, 59, 90):
            xs = [(values[(k, q)], values[(k, q - lag)]) for q in range(8000, 8060) if (k, q) in values and (k, q - lag) in values]
            if xs:
                p = pearson(xs) if len(xs) >= 3 else None
                want[(k, lag)] = (len(xs), p and round(p, 8))
    assert found == want
    with pytest.raises(Exception, match="repeated quarter"):
        screen.autocorrelation(s.union(s), ["k"], "v", [1]).collect()
    with pytest.raises(Exception, match="two values"):
        screen.redundancy(df.union(df), "m").collect()



def test_statistics_on_flat_and_short_groups(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (None, 5.0)], "x double, y double")
    assert df.agg(stats.pearson(F.col("x"), F.col("y"))).first()[0] is None
    assert df.agg(stats.adjusted_skew(F.col("x"))).first()[0] is None
    ranks = spark.createDataFrame([("k", 1.0), ("k", 1.0), ("k", 3.0), ("k", None)], "k string, x double").withColumn("r", stats.average_rank("x", "k"))
    assert sorted((r.r or 0) for r in ranks.collect()) == [0, 1.5, 1.5, 3.0]
    n = spark.range(1).select(stats.effective_n(F.lit(20), F.lit(0.5), F.lit(0.5)).alias("a"), stats.effective_n(F.lit(20), F.lit(-0.5), F.lit(0.5)).alias("b"), stats.effective_n(F.lit(2), F.lit(0.9), F.lit(0.9)).alias("c"), stats.lower_bound(F.lit(0.1), F.lit(5.0)).alias("d")).first()
    assert (n.a, n.b, n.c, n.d) == (12.0, 20.0, 1.0, 0.0)


def test_signal_lists_change(spark):
    a = spark.createDataFrame([("P", "f", 0), ("P", "f", 1)], "polygon_id string, feature string, lag int")
    b = spark.createDataFrame([("P", "f", 1), ("P", "g", 1)], "polygon_id string, feature string, lag int")
    assert {(r.feature, r.lag, r.change) for r in screen.list_change(a, b).collect()} == {("f", 0, "drops out"), ("g", 1, "enters")}


def test_quarters_shift_over_years(spark):
    y, q = calendar.shift_quarter(F.lit(2024), F.lit(1), -1)
    assert tuple(spark.range(1).select(y, q).first()) == (2023, 4)


# --- fields -----------------------------------------------------------------------------------------


def test_fields(spark):
    one = spark.range(1)
    get = lambda c: one.select(c).first()[0]
    assert get(fields.convert(F.lit(212.0), F.lit("°F"), "degC")) == 100.0 and get(fields.convert(F.lit(1.0), F.lit("m"), "degC")) is None
    assert get(fields.unit_refused(F.lit("m"), "degC")) and not get(fields.unit_refused(F.lit("deg C"), "degC"))
    assert get(fields.number(F.lit("999.0"), 999.0)) is None and get(fields.number(F.lit("MM"))) is None and get(fields.number(F.lit("NaN"))) is None
    assert get(fields.unreadable(F.lit("abc"))) and not get(fields.unreadable(F.lit("MM")))
    assert abs(get(fields.dms(F.lit("32° 52' 00\" N"))) - 32.866667) < 1e-5 and get(fields.dms(F.lit("117 15 30 W"))) < 0
    assert get(fields.interval_seconds(F.lit("0 hour 10 minutes 5 seconds"))) == 605 and get(fields.interval_seconds(F.lit("?"))) is None
    assert tuple(one.select(*fields.file_parts(F.lit("name__123__r1.csv"))).first()) == ("name", "123", "r1")
    assert get(calendar.clock(F.lit(905))) == 545 and get(calendar.clock(F.lit(None).cast("int"))) == 638 and get(calendar.clock(F.lit(2460))) is None
    local = F.lit("2024-11-03 01:30:00").cast("timestamp_ntz")
    assert str(get(calendar.to_utc_at_first(local, local, F.lit("America/Los_Angeles")).cast("string"))) == "2024-11-03 08:30:00"


# --- sources -----------------------------------------------------------------------------------------


def test_buoy_files(spark, tmp_path):
    live = "#YY  MM DD hh mm WDIR WSPD WVHT DPD WTMP ATMP PTDY\n#yr mo dy hr mn degT m/s m sec degC degC hPa\n2024 01 01 00 10 MM 3.0 MM 8 15.5 MM -1\n"
    old = "#YY  MM DD hh mm WDIR WSPD WVHT DPD WTMP ATMP\n#yr mo dy hr mn degT m/s m sec degC degC\n2015 01 01 00 30 999 99.0 99.00 99.0 999.0 12.0\n"
    (tmp_path / "46254_realtime.txt").write_text(live)
    with gzip.open(tmp_path / "46254h2015.txt.gz", "wt") as f:
        f.write(old)
    stations = spark.createDataFrame([("46254", "sea_water_temperature", 0.5), ("46254", "wave_significant_height", None)], "station string, parameter string, depth_m double")
    got = {(r.timestamp, r.parameter): (r.value, r.qc_flag, r.depth_m) for r in text.buoy(spark, str(tmp_path), stations).collect()}
    assert got == {
        (dt.datetime(2024, 1, 1, 0, 10), "sea_water_temperature"): (15.5, 2, 0.5), (dt.datetime(2024, 1, 1, 0, 10), "wave_significant_height"): (None, 9, None),
        (dt.datetime(2015, 1, 1, 0, 30), "sea_water_temperature"): (None, 9, 0.5), (dt.datetime(2015, 1, 1, 0, 30), "wave_significant_height"): (None, 9, None),
    }


@pytest.mark.parametrize("lines,why", [
    ("#YY MM DD hh mm WTMP\n#yr mo dy hr mn degF\n2024 1 1 0 0 60.0\n", "WTMP is declared in 'degF'"), ("#YY MM DD hh mm WVHT\n2024 1 1 0 0 1.0\n", "two # lines"),
    ("#YYYY MM DD hh WTMP\n#yr mo dy hr degC\n1999 1 1 0 15.0\n", "first columns"), ("#YY MM DD hh mm WSPD\n#yr mo dy hr mn\n2024 1 1 0 0 1.0\n", "WSPD is declared in None"),
])
def test_buoy_files_of_another_unit_or_layout_are_refused(spark, tmp_path, lines, why):
    (tmp_path / "46254_a.txt").write_text(lines)
    stations = spark.createDataFrame([("46254", "sea_water_temperature", 0.5)], "station string, parameter string, depth_m double")
    with pytest.raises(Exception, match=why):
        text.buoy(spark, str(tmp_path), stations).collect()


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_byte_ranges_give_every_line_once(spark, tmp_path, size):
    r = __import__("random").Random(size)
    lines = [" ".join(str(r.randint(0, 10 ** r.randint(1, 9))) for _ in range(6)) for _ in range(60)]
    body = "#YY MM DD hh mm WTMP\n#yr mo dy hr mn degC\n" + "\n".join(x + "\n" * (i % 11 == 0) + "\r" * (i % 5 == 0) for i, x in enumerate(lines))
    (tmp_path / "a_1.txt").write_text(body, newline="")
    (tmp_path / "b_1.txt").write_text(body + "\n# a remark\n", newline="")
    (tmp_path / "c_1.txt").write_text("#YY MM DD hh mm WTMP\n#yr mo dy hr mn degC\n")
    (tmp_path / "_skipped").write_text("no head")
    with gzip.open(tmp_path / "z_1.txt.gz", "wt", newline="") as f:
        f.write(body)
    got = headed.read(spark, str(tmp_path), "hash", ["YY", "WTMP", "GST"], ["GST"], {"WTMP": "degC"}, range_bytes=size).collect()
    want = [(x.split()[0], x.split()[5], None) for x in lines]
    for name in ("a_1.txt", "b_1.txt", "z_1.txt.gz"):
        rows = sorted((g for g in got if g.file == name), key=lambda g: g.place)
        assert [(g.YY, g.WTMP, g.GST) for g in rows] == want and not any(g.has_GST for g in rows)
        assert all(body[g.place :].startswith(g.YY + " ") for g in rows)
    assert {g.file for g in got} == {"a_1.txt", "b_1.txt", "z_1.txt.gz"}


def test_profile_files(spark, tmp_path):
    head = ",".join(text.PROFILE_COLUMNS) + "\nUTC,degrees_north,degrees_east,m,degree_C,1,1\n"
    (tmp_path / "bay_2025-06.csv").write_text(head + "2025-06-01T00:00:00Z,32,-117,-1.0,15.0,1,11111111111\n2025-06-01T00:00:00Z,32,-117,-5.0,NaN,9,NaN\n2025-06-01T00:10:00Z,32,-117,-1.0,NaN,9,NaN\n2025-06-01T00:00:00Z,32,-117,-9.0,14.0,4,11141111111\n")
    declared = spark.createDataFrame([("bay", 1.0), ("bay", 5.0)], "site_id string, depth_m double")
    rows = text.moored_profile(spark, str(tmp_path), declared).orderBy("depth_m").collect()
    assert [(r.depth_m, r.value, r.qc_flag) for r in rows] == [(1.0, 15.0, 1), (5.0, None, 9)]
    assert rows[0].qc_tests.startswith("gross_range:pass;spike:pass") and rows[1].qc_tests == ""
    assert text.header_units(spark, str(tmp_path), text.PROFILE_COLUMNS).filter("column = 'z'").first()["unit"] == "m"
    loose = text.moored_profile(spark, str(tmp_path), declared.limit(0))
    assert loose.count() == 2
    assert text.surprise_depths(loose, declared).collect()[0].depth_m == 9.0


def test_depth_columns_grid_and_canopy(spark, tmp_path):
    a, b, c = tmp_path / "a", tmp_path / "b", tmp_path / "c"
    for p in (a, b, c):
        p.mkdir()
    (a / "m.csv").write_text("time,latitude,longitude," + ",".join(text.DEPTH_COLUMNS) + "\nUTC,n,e" + "," * 9 + "\n2010-06-01T00:00:00Z,33,117,15,14,NaN,12,11,10,9,8,7\n")
    rows = text.depth_columns(spark, str(a), "M").orderBy("depth_m").collect()
    assert len(rows) == 9 and rows[2].qc_flag == 9 and rows[0].depth_m == 1.0 and rows[8].value == 7.0
    (b / "bed_2020.csv").write_text("time,latitude,longitude,analysed_sst\nUTC,n,e,C\n2020-07-01T09:00:00Z,32.95,-117.28,18.5\n2020-07-01T09:00:00Z,32.96,-117.28,-7.768\n")
    cells = text.grid(spark, str(b)).orderBy("latitude").collect()
    assert [(r.site_id, r.value) for r in cells] == [("bed", 18.5), ("bed", None)]
    (c / "p1.csv").write_text(",".join(text.CANOPY_COLUMNS) + "\n2020,1,900,1,10,10\n2020,2,0,0,0,10\n2020,max,900,1,10,10\n")
    polygons = spark.createDataFrame([("p1.csv", "P1")], "file string, polygon_id string")
    got = text.canopy(spark, str(c), polygons).orderBy("quarter")
    assert [(r.quarter, r.area_m2, r.n_cells_observed) for r in got.collect()] == [(1, 900.0, 10), (2, None, 0)]
    assert text.derived_rows(spark, str(c)).first().n_derived == 1
    assert checks.canopy_counts(got).first().repeated == 0


def test_shore_archive(spark, tmp_path):
    body = (
        "﻿Station: Some Pier\nPosition: 32° 52' 00\" N 117° 15' 30\" W\nSurface depth 0.5 m\nBottom depth 5 m\nArchived 2024-05-06 doi 10.5555/abc\n"
        "YEAR,MONTH,DAY,TIME_PST,TIME_FLAG,SURF_TEMP_C,SURF_FLAG,BOT_TEMP_C,BOT_FLAG,,\n1916,8,22,,,19.5,0,NaN,,,\n1990,1,2,905,0,15.0,2,14.0,5,,\n,,,,,,,,,,\n"
    )
    (tmp_path / "a.csv").write_text(body, encoding="utf-8")
    rows = text.shore_archive(spark, str(tmp_path), 0.5, 5.0, "PIER").orderBy("timestamp", "depth_m").collect()
    assert [(str(r.timestamp), r.depth_m, r.value, r.qc_flag) for r in rows] == [
        ("1916-08-22 18:38:00", 0.5, 19.5, 1), ("1990-01-02 17:05:00", 0.5, 15.0, 3), ("1990-01-02 17:05:00", 5.0, 14.0, 4),
    ]
    h = text.shore_header(spark, str(tmp_path)).first()
    assert (h.station, h.surface_m, h.bottom_m, str(h.archive_date), h.doi) == ("Some Pier", 0.5, 5.0, "2024-05-06", "10.5555/abc")
    assert abs(h.latitude - 32.8667) < 1e-3 and abs(h.longitude + 117.2583) < 1e-3
    sites = spark.createDataFrame([("S1", h.latitude, h.longitude), ("S2", 33.0, -117.0)], "site_id string, lat double, lon double")
    files = spark.createDataFrame([("a.csv", h.latitude, h.longitude), ("b.csv", 10.0, 10.0)], "file string, lat double, lon double")
    assert {(r.file, r.site_id, r.outcome) for r in checks.match_site(files, sites).collect()} == {("a.csv", "S1", "accepted"), ("b.csv", None, "quarantined")}


def test_logger_rows(spark):
    t = dt.datetime(2024, 7, 1, 12)
    sheet = spark.createDataFrame([("f", 1, t, 68.0), ("f", 2, t + dt.timedelta(minutes=10), None), ("f", 3, None, 1.0), ("f", 4, t + dt.timedelta(days=9), 68.0)], "file string, row_number long, timestamp_local timestamp_ntz, `Tidbit 1 , °F` double")
    rows = text.logger_rows(sheet, ["Tidbit 1 , °F"])
    assert rows.count() == 3 and rows.first().series == "Tidbit 1"
    mapping = spark.createDataFrame([("Tidbit 1", "temp")], "series string, parameter string")
    dep = spark.createDataFrame([("f", "A", 1.0, "America/Los_Angeles", dt.datetime(2024, 7, 1), dt.datetime(2024, 7, 3))], "file string, site_id string, depth_m double, zone string, w_start timestamp_ntz, w_end timestamp_ntz")
    got = text.logger_observations(rows, mapping, dep).orderBy("timestamp").collect()
    assert [(str(r.timestamp), r.value, r.qc_flag) for r in got] == [("2024-07-01 19:00:00", 20.0, 2), ("2024-07-01 19:10:00", None, 9), ("2024-07-10 19:00:00", 20.0, 4)]
    audit = checks.cadence_audit(rows.withColumn("interval_s", F.lit(600))).first()
    assert audit.n_off == 1 and len(audit.first_off) == 1


# --- storage -----------------------------------------------------------------------------------------


def test_merge_newest_run_wins_and_other_partitions_stay(spark, tmp_path):
    root = str(tmp_path / "obs")
    zones.write_observations(obs(spark, [1.0, 2.0], run="r1", depth=None), root)
    zones.write_observations(obs(spark, [5.0], run="r2", depth=None).unionByName(obs(spark, [7.0], source="t")), root)
    zones.write_observations(obs(spark, [9.0], run="r0", depth=None), root)
    got = zones.read_observations(spark, root, "s").orderBy("timestamp").collect()
    assert [(r.value, r.fetch_run_id) for r in got] == [(5.0, "r2"), (2.0, "r1")]
    before = zones.fingerprint(zones.read_observations(spark, root)).first()
    zones.write_observations(obs(spark, [5.0], run="r2", depth=None), root)
    assert zones.fingerprint(zones.read_observations(spark, root)).first() == before
    assert {r.source for r in zones.stored_sources(spark, root).collect()} == {"s", "t"}
    assert zones.read_observations(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("step", ["data", "between", "manifest"])
def test_a_killed_write_leaves_the_old_table_whole(spark, tmp_path, monkeypatch, step):
    root, table = str(tmp_path / "obs"), str(tmp_path)
    zones.write_observations(obs(spark, [1.0, 2.0]).unionByName(obs(spark, [3.0], source="t/u v=w")), root)
    zones.write_features(spark.createDataFrame([("s", 1.0), (None, 2.0)], "source string, mean double"), table, "validation", ["source"], ["s"])
    before = sorted(map(str, zones.read_observations(spark, root).collect()))

    def dies(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        if step == "data":  # some files of the commit are there, no manifest
            df = obs(spark, [8.0], run="r9").withColumn("year", F.lit(2024))
            df.write.partitionBy("source", "year").parquet(f"{root}/commit=half")
            m.setattr(zones, "dedupe", dies)
        else:
            m.setattr(snapshots, "_publish" if step == "between" else "_partitions", dies)
        with pytest.raises(KeyboardInterrupt):
            zones.write_observations(obs(spark, [9.0], run="r9"), root)
        if step == "between":
            with pytest.raises(KeyboardInterrupt):
                zones.replace_features(spark.createDataFrame([("x", 1.0)], "source string, mean double"), table, "validation", ["source"])
    assert sorted(map(str, zones.read_observations(spark, root).collect())) == before
    assert {r.source for r in zones.read_features(spark, table, "validation", "source string, mean double").collect()} == {"s", None}
    zones.write_observations(obs(spark, [9.0], run="r9"), root)
    assert [r.value for r in zones.read_observations(spark, root, "s").orderBy("timestamp").collect()] == [9.0, 2.0]
    assert [r.value for r in zones.read_observations(spark, root, "t/u v=w", (2024, 2024)).collect()] == [3.0]
    after = sorted(map(str, zones.read_observations(spark, root).collect()))
    assert snapshots.expire(spark, root, 1) > 0 and sorted(map(str, zones.read_observations(spark, root).collect())) == after


def test_readers_keep_their_snapshot_and_one_of_two_writers_fails(spark, tmp_path):
    root = str(tmp_path / "obs")
    zones.write_observations(obs(spark, [1.0]), root)
    reader, base = zones.read_observations(spark, root), snapshots.current(spark, root)
    zones.write_observations(obs(spark, [5.0], run="r5"), root)
    assert [r.value for r in reader.collect()] == [1.0] and base.number == 1
    with pytest.raises(RuntimeError, match="another writer"):
        snapshots.commit(obs(spark, [7.0]).withColumn("year", F.lit(2024)), root, base, ("source", "year"))
    assert [r.value for r in zones.read_observations(spark, root).collect()] == [5.0]


def test_what_is_no_observation_is_refused_at_the_door(spark, tmp_path):
    root = str(tmp_path / "obs")
    zones.write_observations(obs(spark, [1.0]), root)
    good = obs(spark, [2.0])
    for bad in (
        good.drop("qc_tests"), good.withColumn("more", F.lit(1)), good.select(*reversed(good.columns)), good.withColumn("value", F.col("value").cast("string")),
        good.withColumn("timestamp", F.col("timestamp").cast("timestamp")), good.withColumn("qc_flag", F.lit(5).cast("tinyint")), good.withColumn("qc_flag", F.lit(None).cast("tinyint")),
        good.withColumn("value", F.lit(float("nan"))),
    ):
        with pytest.raises(ValueError, match="not observations"):
            zones.write_observations(bad, root)
    assert [r.value for r in zones.read_observations(spark, root).collect()] == [1.0]
    zones.write_observations(good.limit(0), root)
    assert snapshots.current(spark, root).number == 1


def test_fingerprints_know_rows_and_repeats_but_no_order(spark):
    def of(*rows):
        return tuple(zones.fingerprint(spark.createDataFrame(list(rows), "a string, b string").repartition(3)).first())

    assert of(("a|b", "c")) != of(("a", "b|c")) and of((None, "x")) != of(("~", "x")) and of(("a\\\\|", "b")) != of(("a\\\\", "|b"))
    assert of(("a", "b"), ("c", "d")) == of(("c", "d"), ("a", "b")) and of(("a", "b")) != of(("a", "b"), ("a", "b"))
    assert of() == (0, "0" * 32) and len(of(("a", None))[1]) == 32
    df = spark.range(500).selectExpr("cast(id % 7 AS string) AS k", "cast(id AS string) AS v")
    whole = zones.fingerprint(df).first()
    assert zones.merged_fingerprints(zones.fingerprint(df, "k")).first() == whole
    other = df.filter("v <> '8'").union(df.filter("v = '9'")).union(spark.createDataFrame([("new", "1")], "k string, v string"))
    assert sorted(r.k for r in zones.changed_partitions(other, df, "k").collect()) == ["1", "2", "new"]


def test_days_that_do_not_add_up_are_refused(spark):
    key = "site_id string, serial string, deployment_number long, parameter string, depth_m double"
    coarse = spark.createDataFrame([("A", "1", 1, "temp", None, 4, 2, 6.0, 15.0)], key + ", n_obs long, n_days_observed long, expected_obs double, mean double")
    days = [("A", "1", 1, "temp", None, 2, 3.0, 14.0, 14.0, 14.0), ("A", "1", 1, "temp", None, 2, 3.0, 16.0, 16.0, 16.0)]
    schema = key + ", n_obs long, expected_obs double, mean double, min double, max double"
    good = validation.grain_audit(coarse, spark.createDataFrame(days, schema))
    row = validation.agreed(good).first()
    assert row.counts_agree and row.means_agree and row.expected_agrees and row.site_id == "A"
    short = validation.grain_audit(coarse, spark.createDataFrame([days[0], (*days[1][:6], 2.5, *days[1][7:])], schema))
    assert not short.first().expected_agrees
    with pytest.raises(Exception, match="disagree"):
        validation.agreed(short).collect()


def test_what_the_audit_excludes_is_not_screened(spark):
    env = "source string, site_id string, parameter string, depth_m double"
    audit = spark.createDataFrame([("s", "A", "t", None, "max", "excluded"), ("s", "A", "t", None, "mean", "low_resolution"), ("s", "B", "t", 1.0, "mean", "not_applicable")], env + ", feature string, verdict string")
    cells = spark.createDataFrame([("s", site, "t", d, f) for site, d in (("A", None), ("B", 1.0), ("B", None)) for f in ("max_anom", "mean_anom")], env.replace("source", "env_source") + ", feature string")
    got = sorted((r.site_id, r.depth_m is None, r.feature) for r in screen.without_skipped(cells, audit).collect())
    assert got == [("A", True, "mean_anom"), ("B", False, "max_anom"), ("B", True, "max_anom"), ("B", True, "mean_anom")]


def test_builds_count_what_they_leave_out_in_their_own_pass(spark, tmp_path):
    seen = Watch()
    df = obs(spark, [15.0, 16.0, None]).unionByName(obs(spark, [1.0] * 4).withColumn("parameter", F.lit("other"))).unionByName(obs(spark, [None], site="B"))
    zones.replace_features(features.build_quarterly(df, {"temp": {}}, 0.1, "2030-01-01", watch=seen), str(tmp_path), "quarterly_env", ["site_id"])
    assert {(r.warning, r.n_rows) for r in seen.warnings(spark).collect()} == {("rows_of_unbuilt_parameters", 4), ("quarters_without_rows", 1)}
    seen = Watch()
    sheet = spark.createDataFrame([("f", i, T0, s, "degC", 1.0) for i, s in enumerate("aab")], "file string, row_number long, timestamp_local timestamp_ntz, series string, unit string, value double")
    deployed = spark.createDataFrame([("f", "A", 1.0, "UTC", T0, T0)], "file string, site_id string, depth_m double, zone string, w_start timestamp_ntz, w_end timestamp_ntz")
    mapping = spark.createDataFrame([("a", "temp")], "series string, parameter string")
    assert text.logger_observations(sheet, mapping, deployed, vocabulary=["temp"], watch=seen).collect()[1].parameter == "temp"
    assert [tuple(r) for r in seen.warnings(spark).collect()] == [("logger", "rows_of_unmapped_series", 1)]
    with pytest.raises(Exception, match="unknown parameter"):
        text.logger_observations(sheet, mapping, deployed, vocabulary=["salt"]).collect()


def test_the_report_names_the_tests_that_ran(spark):
    declared = {"temp": {"spike": (1.5, 3.0), "rate_per_hour": (None, 36.0), "by_source": {"x": ("spike", "gross_range")}}, "salt": PARAMETERS["temp"]}
    df = obs(spark, [1.0] * 3).unionByName(obs(spark, [1.0] * 2, source="x")).unionByName(obs(spark, [1.0], site="B").withColumn("parameter", F.lit("salt"))).unionByName(
        obs(spark, [1.0], site="C").withColumn("parameter", F.lit("unknown")))
    got = {(r.source, r.site_id): (r.tests, r.notes) for r in quality.evaluation_report(df, declared).collect()}
    assert got == {
        ("s", "A"): ("spike", "gross_range not run: no valid_range; rate_of_change not run: no suspect rate"), ("x", "A"): ("", "rate_of_change not run: no suspect rate"),
        ("s", "B"): ("gross_range", "spike not run: fewer than three rows; rate_of_change not run: fewer than two rows"),
    }


def test_source_scoped_replacement(spark, tmp_path):
    root = str(tmp_path)
    a = spark.createDataFrame([("s", 1.0), ("t", 2.0)], "source string, mean double")
    zones.write_features(a, root, "quarterly_env", ["source"], ["s", "t"])
    zones.write_features(spark.createDataFrame([("s", 5.0, 1)], "source string, mean double, extra int"), root, "quarterly_env", ["source"], ["s"])
    got = zones.read_features(spark, root, "quarterly_env", "source string, mean double, extra int").orderBy("source").collect()
    assert [tuple(r) for r in got] == [("s", 5.0, 1), ("t", 2.0, None)]
    with pytest.raises(ValueError):
        zones.read_features(spark, root, "other", "a int")
    assert zones.read_features(spark, root, "validation", "a int").count() == 0


def test_cell_weights(spark):
    cells = spark.createDataFrame([(33.0, -117.0), (33.01, -117.0), (40.0, 0.0)], "latitude double, longitude double")
    ring = [(-117.005, 32.995), (-116.995, 32.995), (-116.995, 33.005), (-117.005, 33.005)]
    rows = grid.cell_weights(cells, ring).collect()
    assert len(rows) == 1 and rows[0].latitude == 33.0 and 1.0e6 < rows[0].weight < 1.1e6
    whole = rows[0].weight
    inner = [(x / 2 - 117.0 / 2, y / 2 + 33.0 / 2) for x, y in ring]  # half as wide about the same middle
    holed = grid.cell_weights(cells, [[ring, inner]]).first().weight
    assert abs(holed / whole - 0.75) < 1e-6
    far = [(x, y + 0.01) for x, y in ring]
    parts = {r.latitude: r.weight for r in grid.cell_weights(cells, [[ring], [far, [(x, y + 0.01) for x, y in inner]]]).collect()}
    assert abs(parts[33.0] / whole - 1) < 1e-12 and abs(parts[33.01] / whole - 0.75) < 1e-3
    diagonal = grid.cell_weights(cells, [ring[0], ring[1], ring[2]]).first().weight
    assert abs(diagonal / whole - 0.5) < 1e-4
    for nowhere in ([(10.0, 10.0), (10.1, 10.0), (10.1, 10.1)], [(-117.0051, 33.02), (-117.0, 33.02), (-117.0, 33.03)]):
        with pytest.raises(ValueError, match="meets no cell"):
            grid.cell_weights(cells, nowhere)


@pytest.mark.parametrize("lon,lat,zone", [(-117.25, 32.86, 11), (-119.9, 34.4, 11), (-79.387, 43.6426, 17), (5.999, 0.005, 31), (151.2, -33.86, 56)])
def test_projected_areas_equal_the_ellipsoid_times_the_scale(lon, lat, zone):
    import numpy as np

    assert grid.utm_zone(lon) == zone
    e2 = grid.FLATTENING * (2 - grid.FLATTENING)
    phi = np.radians(lat + (np.arange(400) + 0.5) / 400 * 0.01 - 0.005)
    on_ellipsoid = np.sum(grid.A_AXIS**2 * (1 - e2) * np.cos(phi) / (1 - e2 * np.sin(phi) ** 2) ** 2) * np.radians(0.01) / 400 * np.radians(0.01)
    # the scale of the projection as Snyder (1987) gives it
    f, x = np.radians(lat), np.radians(lon - (6 * zone - 183)) * np.cos(np.radians(lat))
    c, t = e2 / (1 - e2) * np.cos(f) ** 2, np.tan(f) ** 2
    k = grid.SCALE * (1 + (1 + c) * x**2 / 2 + (5 - 4 * t + 42 * c + 13 * c * c - 28 * e2 / (1 - e2)) * x**4 / 24)
    box = grid.utm(lon + np.array([-1, 1, 1, -1]) * 0.005, lat + np.array([-1, -1, 1, 1]) * 0.005, zone)
    assert abs(grid.clip_area(box, box) / (on_ellipsoid * k * k) - 1) < 1e-6
    if zone == 17:
        assert np.allclose(grid.utm(-79.387139, 43.642567, 17), [630084.0, 4833438.0], atol=2.0)


def test_gates(spark):
    files = spark.createDataFrame([("a", "s1", None), ("b", "s2", 2), ("c", "s2", None), ("d", "zz", None)], "file string, serial string, file_number long")
    dep = spark.createDataFrame([("s1", 1, T0, T0), ("s2", 1, T0, T0), ("s2", 2, T0, T0), ("zz", 1, None, T0)], "serial string, deployment_number long, w_start timestamp_ntz, w_end timestamp_ntz")
    assert {(r.file, r.deployment_number) for r in checks.registry_gate(files, dep).collect()} == {("a", 1), ("b", 2), ("c", None), ("d", None)}
    years = spark.createDataFrame([("x", y) for y in (2000, 2010, 2020)], "station string, year int")
    sets = spark.createDataFrame([("x", "old", 2005), ("x", "mid", 2020), ("x", "new", None)], "station string, dataset string, ends_at int")
    assert {(r.year, r.dataset) for r in checks.dataset_owner(years, sets).collect()} == {(2000, "old"), (2010, "mid"), (2020, "new")}
    rows = spark.createDataFrame([("f", "serial", "pass", ""), ("f", "time zone", "fail", ""), ("g", "serial", "pass", "")], "file string, check string, status string, detail string")
    assert {(r.file, r.outcome, r.blocked_by) for r in checks.outcome(rows, ["serial", "time zone"]).collect()} == {("f", "quarantined", "time zone"), ("g", "accepted", None)}


def test_lag_feature_matrix_keeps_series_apart(spark):
    schema = "polygon_id string, env_source string, site_id string, parameter string, depth_m double, lag int, feature string, r double"
    rows = [("P0", "N", s, "O", None, k, "mean", r) for s, k, r in (("S0", 0, 0.1), ("S0", 1, 0.2), ("S1", 0, 0.3), ("S1", 4, None))]
    got = {r.site_id: (r["0"], r["1"], r["4"]) for r in screen.lag_feature_matrix(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"S0": (0.1, 0.2, None), "S1": (0.3, None, None)}
    with pytest.raises(Exception, match="two cells"):
        screen.lag_feature_matrix(spark.createDataFrame(rows + rows[:1], schema)).collect()


def test_a_series_that_is_no_column_of_the_matrix_is_refused(spark):
    rows = spark.createDataFrame([(2000, 1, "N", "S0", "O", None, 1.5), (2000, 1, "N", "S1", "O", 2.0, None)], "year int, quarter tinyint, source string, site_id string, parameter string, depth_m double, mean double")
    assert [tuple(r) for r in screen.quarter_matrix(rows, "mean", ["N|S0|O|-", "N|S9|O|-"]).collect()] == [(2000, 1, 1.5, None)]
    with pytest.raises(Exception, match="no column of the matrix"):
        screen.quarter_matrix(rows, "mean", ["N|S9|O|-"]).collect()


def test_rates_that_no_step_can_reach(spark):
    far = quality.unreachable_rates(obs(spark, [15.0, 15.0, 15.0], minutes=60 * 24 * 20, site="slow").unionByName(obs(spark, [15.0, 15.0], site="fast")).unionByName(obs(spark, [15.0], site="one")), PARAMETERS)
    assert [(r.site_id, r.least_s) for r in far.collect()] == [("slow", 20 * 86400.0)]
