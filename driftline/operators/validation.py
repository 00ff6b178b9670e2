"""Agreement of deployments with reference series, and audits of one grain against the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driftline.functions import naming
from driftline.functions.fields import refused
from driftline.functions.stats import depth_comparable, depth_gap, null_safe_join, pearson
from driftline.operators.features import DEPLOYMENT, deployment_rows
from driftline.operators.windowed import cadence_of
from driftline.session import written

PAIR = [*DEPLOYMENT, "ref", "ref_depth_m"]
SERIES_OF_REF = ["ref", "parameter", "ref_depth_m"]


#: Pairs of kin that are folded on the driver at most; more are folded by joins.
HELD_KIN = 10_000


def fold_platforms(refs: DataFrame, kin: DataFrame, held: int = HELD_KIN) -> DataFrame:
    """(site_id, ref, platform, ordinal): references that are kin share the platform of the first.

    ``refs`` has site_id, ref and ordinal (the declared order), ``kin`` pairs (a, b) of
    references on one platform. Kinship is symmetric and followed to the end.
    """
    pairs = kin.filter("a is not null and b is not null").select("a", "b").distinct()
    few = pairs.limit(held + 1).collect()  # the registry's few pairs, or the sign that there are more
    groups = _led(refs.sparkSession, few) if len(few) <= held else components(pairs)
    w = W.partitionBy("site_id", "package")
    return (
        refs.join(groups, "ref", "left").withColumn("package", F.coalesce("package", "ref"))
        .select("site_id", "ref", F.min("ordinal").over(w).alias("platform"), "ordinal")
    )


def _led(spark: SparkSession, pairs: list) -> DataFrame:
    """ref, package (the first of its kin) of a bounded list of pairs."""
    leader: dict[str, str] = {}

    def lead(x: str) -> str:
        while leader.get(x, x) != x:
            leader[x] = leader.get(leader[x], leader[x])
            x = leader[x]
        return x

    for a, b in pairs:
        first, second = sorted((lead(a), lead(b)))
        leader[second] = first
    return F.broadcast(spark.createDataFrame([(x, lead(x)) for x in leader], "ref string, package string"))


def components(pairs: DataFrame) -> DataFrame:
    """ref, package: every member of ``pairs`` (a, b) with the first member that can be reached from it.

    Each round a member's parent, and its parent's, take the least grandparent of its
    neighbours, and every member skips to its grandparent; rounds grow with the logarithm of the
    longest chain. Parents are written once a round, which cuts the lineage.
    """
    both = written(pairs.select("a", "b").union(pairs.select("b", "a")).filter("a <> b").distinct(), "kin")
    parents = written(both.groupBy(F.col("a").alias("ref")).agg(F.least(F.col("a"), F.min("b")).alias("p")), "parents")
    while True:
        up = parents.join(parents.select(F.col("ref").alias("p"), F.col("p").alias("g")), "p").select("ref", "p", "g")
        near = both.join(up.select(F.col("ref").alias("b"), F.col("g").alias("low")), "b").groupBy("a").agg(F.min("low").alias("low"))
        seen = up.join(near.withColumnRenamed("a", "ref"), "ref")
        offers = seen.select("ref", F.least("p", "g", "low").alias("p")).union(seen.select(F.col("p").alias("ref"), F.col("low").alias("p")))
        after = written(offers.groupBy("ref").agg(F.min("p").alias("p")), "parents")
        moved = after.join(parents.withColumnRenamed("p", "old"), "ref").filter("p <> old").limit(1).count()
        parents = after
        if not moved:
            return parents.withColumnRenamed("p", "package")


def choose_references(folded: DataFrame, present: DataFrame) -> DataFrame:
    """site_id, parameter, ref, collapsed_refs: of each platform the first reference with rows of a parameter.

    ``present`` has ref and parameter of what rows there are. The platform's other
    references are listed in collapsed_refs, whether they have rows or not.
    """
    group = folded.groupBy("site_id", "platform").agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "ref"))), lambda m: m["ref"]).alias("refs"))
    first = (
        folded.join(present.select("ref", "parameter").distinct(), "ref")
        .groupBy("site_id", "platform", "parameter").agg(F.min_by("ref", "ordinal").alias("ref"))
    )
    return first.join(group, ["site_id", "platform"]).select(
        "site_id", "parameter", "ref", F.array_join(F.array_remove("refs", F.col("ref")), ";").alias("collapsed_refs")
    )


def binned(rows: DataFrame, keys: list[str], cadence: str) -> DataFrame:
    """Means of the rows in bins of the pair's cadence."""
    bin_ = F.floor(F.unix_micros(F.col("timestamp").cast("timestamp")) / (F.col(cadence) * 1e6))
    return rows.groupBy(*keys, bin_.alias("bin"), cadence).agg(F.avg("value").alias("x"))


def build_validation(obs: DataFrame, deployments: DataFrame, references: DataFrame, tolerance: float, most: int = 2) -> DataFrame:
    """Deployment x reference x depth: pairs, overlap, r, bias and RMSE.

    ``references`` has site_id, parameter, ref (the site whose series are compared) and
    collapsed_refs. A deployment without a depth or without rows has no row; a reference
    series without a common bin has one with n_pairs 0. Each reference depth is a
    series; source and reference_source are those of its earliest row. Both sides are
    averaged in bins of the coarser median interval, each measured over its whole series (1 s if
    neither is known), and joined on the bin. r is null below three pairs or on
    a flat side; bias and RMSE are null unless the depths are comparable. qc_max_flag
    is ``most``, the policy the row was built with.
    """
    own = deployment_rows(obs, deployments.filter("depth_m is not null"), most).filter("keep")
    own = written(own.select(*DEPLOYMENT, "timestamp", "value", "source", "w_start", "w_end"), "own")  # four parts read it
    wanted = references.select("ref", "parameter").distinct()
    ref = obs.filter((F.col("qc_flag") <= most) & F.col("value").isNotNull()).select(
        F.col("site_id").alias("ref"), "parameter", F.col("depth_m").alias("ref_depth_m"), "timestamp", "value", "source"
    ).join(wanted, ["ref", "parameter"], "left_semi")
    ref = written(ref, "references")
    earliest = lambda name: F.min_by("source", F.struct("timestamp", "source")).alias(name)
    mine = own.groupBy(*DEPLOYMENT, "w_start", "w_end").agg(earliest("source"))
    series = ref.groupBy(*SERIES_OF_REF).agg(earliest("reference_source"))
    mine = null_safe_join(mine, cadence_of(own, DEPLOYMENT).withColumnRenamed("cadence_s", "ca"), DEPLOYMENT)
    series = null_safe_join(series, cadence_of(ref, SERIES_OF_REF).withColumnRenamed("cadence_s", "cb"), SERIES_OF_REF)
    pair = mine.join(references, ["site_id", "parameter"]).join(series, ["ref", "parameter"])
    pair = pair.withColumn("cadence_s", F.coalesce(F.greatest("ca", "cb"), F.lit(1.0))).drop("ca", "cb")
    pair = written(pair, "pairs")  # both sides and the result read it; Spark broadcasts the file while it is small
    x = binned(null_safe_join(own.drop("source", "w_start", "w_end"), pair.select(*PAIR, "cadence_s"), DEPLOYMENT, "inner"), PAIR, "cadence_s")
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("cadence_s").cast("decimal(18,6)"))
    near = F.col("timestamp").between(F.col("w_start") - step, F.col("w_end") + step)  # what can share a bin with the deployment
    theirs = null_safe_join(ref.drop("source"), pair.select(*PAIR, "cadence_s", "w_start", "w_end"), SERIES_OF_REF, "inner").filter(near)
    y = binned(theirs, PAIR, "cadence_s").select(*PAIR, "bin", F.col("x").alias("y"))
    both = null_safe_join(x, y, [*PAIR, "bin"], "inner")
    comparable = depth_comparable(F.col("depth_m"), F.col("ref_depth_m"), tolerance)
    at = lambda b_: F.timestamp_micros(F.round(b_ * F.col("cadence_s") * 1e6).cast("long")).cast("timestamp_ntz")
    found = both.groupBy(*PAIR).agg(
        F.count("*").alias("n_pairs"), F.min("bin").alias("b0"), F.max("bin").alias("b1"),
        pearson(F.col("x"), F.col("y")).alias("r"), F.avg(F.col("x") - F.col("y")).alias("bias"),
        F.sqrt(F.avg(F.pow(F.col("x") - F.col("y"), 2))).alias("rmse"),
    )
    found = null_safe_join(pair, found, PAIR)
    return found.select(
        *PAIR, "source", "reference_source", "collapsed_refs", depth_gap(F.col("depth_m"), F.col("ref_depth_m")).alias("depth_gap_m"), comparable.alias("depth_comparable"),
        "cadence_s", F.coalesce("n_pairs", F.lit(0)).alias("n_pairs"), at(F.col("b0")).alias("overlap_start"), at(F.col("b1")).alias("overlap_end"),
        F.when(F.col("n_pairs") >= 3, F.col("r")).alias("correlation"), F.when(comparable, F.col("bias")).alias("bias"),
        F.when(comparable, F.col("rmse")).alias("rmse"), F.lit(most).alias("qc_max_flag"),
    )


def of_usable(fine: DataFrame, deployment: DataFrame) -> DataFrame:
    """The days or hours of deployments that cleared the coverage floor."""
    return null_safe_join(fine, deployment.filter("usable").select(*DEPLOYMENT), DEPLOYMENT, "left_semi")


def with_validation(deployment: DataFrame, validation: DataFrame) -> DataFrame:
    """Usable deployments with their validation rows; one without any keeps a row of nulls."""
    mine = deployment.filter("usable").select(*DEPLOYMENT, "n_obs", "mean")
    return null_safe_join(mine, validation.drop("source", "qc_max_flag"), DEPLOYMENT)


def depth_groups(fine: DataFrame, stamp: str) -> DataFrame:
    """Days or hours with their group's label and its place by depth at the site, shallowest first."""
    label = F.format_string("%s at %.2f m", "site_id", "depth_m")
    place = F.dense_rank().over(W.partitionBy("site_id").orderBy("depth_m"))
    groups = fine.filter("depth_m is not null").select("site_id", "depth_m").distinct().withColumn("label", label).withColumn("place", place)
    return fine.join(groups, ["site_id", "depth_m"]).select("site_id", "depth_m", "label", "place", stamp, "mean")


def weighted_mean(df: DataFrame, keys: list[str], column: str, weight: str = "n_obs") -> DataFrame:
    """Observation-weighted roll-up of a finer grain's means."""
    return df.groupBy(*keys).agg(
        F.try_divide(F.sum(F.col(column) * F.col(weight)), F.sum(F.when(F.col(column).isNotNull(), F.col(weight)))).alias(column), F.sum(weight).alias(weight)
    )


def grain_audit(coarse: DataFrame, fine: DataFrame, thresholds: dict | None = None, tolerance: float = 1e-9) -> DataFrame:
    """Deployment figures beside those re-derived from their days, and whether they agree.

    ``thresholds`` names what is re-derived from the days' extremes and means:
    days_above, days_below and degree_days_above. The days' expected_obs must add up to the
    deployment's; they fall short by the days that nothing was kept of. A key that occurs
    twice on either side is refused. :func:`agreed` refuses deployments that disagree.
    """
    lab, kinds = naming.threshold_label, thresholds or {}
    more = {f"days_above_{lab(x)}": F.sum((F.col("max") > x).cast("double")) for x in kinds.get("days_above", ())}
    more |= {f"days_below_{lab(x)}": F.sum((F.col("min") < x).cast("double")) for x in kinds.get("days_below", ())}
    more |= {f"degree_days_above_{lab(x)}": F.sum(F.greatest(F.col("mean") - x, F.lit(0.0))) for x in kinds.get("degree_days_above", ())}
    derived = fine.groupBy(*DEPLOYMENT).agg(
        F.sum("n_obs").alias("fine_n_obs"), F.sum("expected_obs").alias("fine_expected"),
        F.try_divide(F.sum(F.col("mean") * F.col("n_obs")), F.sum("n_obs")).alias("fine_mean"), F.count("*").alias("n_spans"),
        *(c.alias(f"fine_{n}") for n, c in more.items()),
    )
    seen = F.count("*").over(W.partitionBy(*DEPLOYMENT))
    coarse = coarse.withColumn("n_obs", refused(seen > 1, "two deployments of one key", F.col("n_obs"), "long"))
    out = null_safe_join(coarse.select(*DEPLOYMENT, "n_obs", "n_days_observed", "expected_obs", "mean", *more), derived, DEPLOYMENT)
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= tolerance * F.greatest(F.lit(1.0), F.abs(F.col(a)))
    out = out.withColumn("counts_agree", (F.col("n_obs") == F.col("fine_n_obs")) & (F.col("n_days_observed") == F.col("n_spans"))).withColumn("means_agree", near("mean", "fine_mean"))
    out = out.withColumn("expected_agrees", near("expected_obs", "fine_expected"))
    agree = F.lit(True)
    for n in more:
        # a parameter without the threshold has none on the coarse side
        agree = agree & F.coalesce(near(n, f"fine_{n}"), F.col(n).isNull())
    return out.withColumn("thresholds_agree", agree) if more else out


def agreed(audit: DataFrame) -> DataFrame:
    """The rows of a :func:`grain_audit`, refused if any figure disagrees with the days."""
    bad = F.lit(False)
    for c in audit.columns:
        if c.endswith(("_agree", "_agrees")):
            bad = bad | ~F.coalesce(c, F.lit(False))
    return audit.withColumn("site_id", refused(bad, "a deployment and its days disagree", F.col("site_id"), "string"))


def band_occupancy(hourly: DataFrame, band: str) -> DataFrame:
    return hourly.groupBy("site_id", "depth_m").agg(F.count(band).alias("n_hours"), F.avg(band).alias("share"))


def exposure_share(deployment: DataFrame, days: list[str]) -> DataFrame:
    """Days beyond each threshold as a share of the observed days, named after the days."""
    return deployment.select(*DEPLOYMENT, "n_days_observed", *days, *(F.try_divide(F.col(d), F.col("n_days_observed")).alias(f"{d}_share") for d in days))


def depth_contrast(deployment: DataFrame, column: str = "mean") -> DataFrame:
    """Shallowest and deepest usable deployment of each site and parameter."""
    u = deployment.filter("usable and depth_m is not null")
    return u.groupBy("site_id", "parameter").agg(
        F.min("depth_m").alias("shallow_m"), F.min_by(column, "depth_m").alias("shallow"), F.max("depth_m").alias("deep_m"), F.max_by(column, "depth_m").alias("deep"),
        F.count_distinct("depth_m").alias("n_depths"),
    ).withColumn("difference", F.col("shallow") - F.col("deep"))


def cumulative_degree_days(daily: DataFrame, threshold: float) -> DataFrame:
    """Running degree-days along each deployment's days, and each day's range."""
    w = W.partitionBy(*DEPLOYMENT).orderBy("day").rowsBetween(W.unboundedPreceding, 0)
    return daily.select(
        *DEPLOYMENT, "day", F.sum(F.greatest(F.col("mean") - threshold, F.lit(0.0))).over(w).alias("degree_days"), (F.col("max") - F.col("min")).alias("daily_range")
    )


def breaks(df: DataFrame, keys: list[str], at: str, most: Column | float) -> DataFrame:
    """A flag on rows that begin after a step of more than ``most``."""
    step = F.col(at) - F.lag(at).over(W.partitionBy(*keys).orderBy(at))
    return df.withColumn("breaks", F.coalesce(step > most, F.lit(False)))


def standardised(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(x - mean) / std within the keys; centred only where the std is 0 or unknown."""
    w = W.partitionBy(*keys)
    sd = F.stddev_samp(column).over(w)
    centred = F.col(column) - F.avg(column).over(w)
    return df.withColumn(f"{column}_z", F.when(sd > 0, centred / sd).otherwise(centred))
