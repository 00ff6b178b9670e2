"""Range, spike and rate tests over series of observations. Rows are flagged, never dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions import calendar, verdicts
from driftline.operators.slices import SLICE, with_neighbours

SERIES = ["source", "site_id", "parameter", "depth_m"]


def _limit(parameters: dict, pick) -> Column:
    """A number for each parameter as a CASE; the vocabulary is a handful of entries."""
    out = F.lit(None).cast("double")
    for name, p in parameters.items():
        x = pick(p)
        if x is not None:
            out = F.when(F.col("parameter") == name, F.lit(float(x))).otherwise(out)
    return out


def _suppressed(parameters: dict, test: str) -> Column:
    out = F.lit(False)
    for name, p in parameters.items():
        for source, tests in p.get("by_source", {}).items():
            if test in tests:
                out = out | ((F.col("parameter") == name) & (F.col("source") == source))
    return out


def gross_range(value: Column, valid: tuple[Column, Column], span: tuple[Column, Column]) -> Column:
    outside = lambda lo, hi: (value < lo) | (value > hi)
    return (
        F.when(valid[0].isNull(), None).when(value.isNull(), "missing").when(outside(*valid), "fail")
        .when(F.coalesce(outside(*span), F.lit(False)), "suspect").otherwise("pass")
    )


def evaluate(obs: DataFrame, parameters: dict, width: str = SLICE) -> DataFrame:
    """qc_flag and qc_tests anew for every row of a known parameter.

    ``parameters`` maps a name to valid_range and, as wanted, suspect_span, spike
    (suspect, fail), rate_per_hour (suspect, fail) and by_source (tests a source is
    excepted from). All tests look at a row and its two neighbours, which come from
    slices of a series (``width``) and their edges, so no task holds a whole series. A
    spike is judged against the mean of both
    neighbours and has no verdict at the ends and beside gaps; a rate has none on the
    first row and after a gap. Verdicts that other stages recorded stay (of a name that
    occurs twice the last), those of tests that no longer run go, and the flag is rolled
    up again. A recorded verdict that cannot be read is refused, as it would be lost.
    Running twice changes nothing. Rows of unknown parameters are left as they are.
    """
    v = F.col("value")
    before, after, n = F.col("__before")["value"], F.col("__after")["value"], F.col("__n")
    dt = calendar.seconds(F.col("timestamp"), F.col("__before")["timestamp"])
    alone, two = n == 1, n == 2
    lim = {
        k: _limit(parameters, f)
        for k, f in {
            "lo": lambda p: p["valid_range"][0] if "valid_range" in p else None, "hi": lambda p: p["valid_range"][1] if "valid_range" in p else None,
            "slo": lambda p: p.get("suspect_span", (None, None))[0], "shi": lambda p: p.get("suspect_span", (None, None))[1],
            "sp": lambda p: p.get("spike", (None, None))[0], "spf": lambda p: p.get("spike", (None, None))[1],
            "ra": lambda p: p.get("rate_per_hour", (None, None))[0], "raf": lambda p: p.get("rate_per_hour", (None, None))[1],
        }.items()
    }
    off = F.abs(v - (before + after) / 2)
    spike = (
        F.when(lim["sp"].isNull() | alone | two, None).when(v.isNull(), "missing").when(off.isNull(), None)
        .when(off > lim["spf"], "fail").when(off > lim["sp"], "suspect").otherwise("pass")
    )
    rate = F.abs(F.try_divide(v - before, dt)) * 3600
    change = (
        F.when(lim["ra"].isNull() | alone, None).when(v.isNull(), "missing").when(before.isNull(), None)
        .when(rate > lim["raf"], "fail").when(rate > lim["ra"], "suspect").otherwise("pass")
    )
    tests = {
        "gross_range": gross_range(v, (lim["lo"], lim["hi"]), (lim["slo"], lim["shi"])),
        "spike": spike,
        "rate_of_change": change,
    }
    tested = with_neighbours(obs, SERIES, ["timestamp", "fetch_run_id"], ["value"], width)
    tested = tested.withColumns({f"__{name}": F.when(~_suppressed(parameters, name), verdict) for name, verdict in tests.items()})
    packed = F.col("qc_tests")
    foreign = F.map_filter(verdicts.parse(verdicts.readable(packed)), lambda k, _: ~k.isin(*tests))
    flag, text = verdicts.merged(packed, F.col("__foreign"), {n: F.col(f"__{n}") for n in tests})
    known = F.col("parameter").isin(*parameters)
    return (
        tested.withColumn("__foreign", F.when(known & (F.coalesce(packed, F.lit("")) != ""), foreign))
        .select(*(c for c in obs.columns if c not in ("qc_flag", "qc_tests")),
                F.when(known, flag).otherwise(F.col("qc_flag")).alias("qc_flag"), F.when(known, text).otherwise(packed).alias("qc_tests"))
        .select(*obs.columns)
    )


def flag_histogram(obs: DataFrame, *keys: str) -> DataFrame:
    """Rows by flag, in all or for each key."""
    return obs.groupBy(*keys, "qc_flag").agg(F.count("*").alias("n_rows"))


def series_report(obs: DataFrame) -> DataFrame:
    """Rows, first and last time and the flags' counts of each series, in one pass."""
    return obs.groupBy(*SERIES).agg(
        F.count("*").alias("n_rows"), F.min("timestamp").alias("first_at"), F.max("timestamp").alias("last_at"),
        *(F.count_if(F.col("qc_flag") == f).alias(f"flag_{f}") for f in (1, 2, 3, 4, 9)),
    )


def evaluation_report(obs: DataFrame, parameters: dict) -> DataFrame:
    """:func:`series_report` of the series of known parameters, with the tests that ran and notes on those that could not.

    A test runs where its thresholds are declared, the source is not excepted from it, and
    the series has rows enough: three for spikes, two for rates. What is declared and
    cannot run is noted; an exception is not, as it is a decision.
    """
    known = series_report(obs.filter(F.col("parameter").isin(*parameters)))
    n, declared = F.col("n_rows"), {t: ~_suppressed(parameters, t) for t in ("gross_range", "spike", "rate_of_change")}
    range_, spike = (_limit(parameters, f) for f in (lambda p: p.get("valid_range", (None,))[0], lambda p: p.get("spike", (None,))[0]))
    rated = F.col("parameter").isin([name for name, p in parameters.items() if p.get("rate_per_hour")])
    rate = _limit(parameters, lambda p: p.get("rate_per_hour", (None,))[0])
    tests = F.array(
        F.when(declared["gross_range"] & range_.isNotNull(), "gross_range"), F.when(declared["spike"] & spike.isNotNull() & (n >= 3), "spike"),
        F.when(declared["rate_of_change"] & rate.isNotNull() & (n >= 2), "rate_of_change"),
    )
    notes = F.array(
        F.when(declared["gross_range"] & range_.isNull(), "gross_range not run: no valid_range"), F.when(declared["spike"] & spike.isNotNull() & (n < 3), "spike not run: fewer than three rows"),
        F.when(declared["rate_of_change"] & rated & rate.isNull(), "rate_of_change not run: no suspect rate"),
        F.when(declared["rate_of_change"] & rate.isNotNull() & (n < 2), "rate_of_change not run: fewer than two rows"),
    )
    return known.withColumns({"tests": F.array_join(F.array_compact(tests), ","), "notes": F.array_join(F.array_compact(notes), "; ")})


def unreachable_rates(obs: DataFrame, parameters: dict) -> DataFrame:
    """Series whose whole valid range over their shortest interval stays below the suspect rate.

    Intervals come from slices of a series and their edges, so no task holds a whole series.
    """
    dt = calendar.seconds(F.col("timestamp"), F.col("__before")["timestamp"])
    span = _limit(parameters, lambda p: p["valid_range"][1] - p["valid_range"][0] if "valid_range" in p else None)
    rate = _limit(parameters, lambda p: p.get("rate_per_hour", (None,))[0])
    near = with_neighbours(obs.select(*SERIES, "timestamp"), SERIES, ["timestamp"], [])
    least = near.withColumn("dt", dt).groupBy(*SERIES).agg(F.min(F.when(F.col("dt") > 0, F.col("dt"))).alias("least_s"))
    return least.withColumn("most_per_hour", span / F.col("least_s") * 3600).filter(F.col("most_per_hour") < rate)


def unmatched_exceptions(obs: DataFrame, parameters: dict) -> DataFrame:
    """Declared (source, parameter) exceptions that touch no series."""
    declared = [(s, n) for n, p in parameters.items() for s in p.get("by_source", {})]
    spark = obs.sparkSession
    return spark.createDataFrame(declared, "source string, parameter string").join(
        obs.select("source", "parameter").distinct(), ["source", "parameter"], "left_anti"
    )
