"""The lag screen: correlations of response and predictors, their effective sizes, and what follows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driftline.functions import calendar, stats
from driftline.functions.fields import refused
from driftline.functions.stats import null_safe_join
from driftline.operators.comparison import gate
from driftline.operators.quality import SERIES
from driftline.session import written

ENV = ["env_source", "site_id", "parameter", "depth_m"]
CELL = ["polygon_id", *ENV, "lag", "feature"]
MIN_PAIRS = 12
MIN_ADJACENT = 3


def long_cells(comparison: DataFrame, features: list[str]) -> DataFrame:
    """Gated rows, one for each feature with a value: cell, q, x (predictor), y (response).

    The features are unpivoted once, whatever their number.
    """
    rows = comparison.filter(gate()).withColumnRenamed("source", "env_source").withColumn(
        "q", calendar.quarter_index(F.col("year"), F.col("quarter"))
    )
    ids = ["polygon_id", *ENV, "lag", "q", "canopy_anom"]
    long = rows.select(*ids, *features).unpivot(ids, features, "feature", "x").filter("x is not null")
    # nine places keep ties from being broken by the last bits of a mean
    return long.withColumn("x", F.round("x", 9)).withColumn("y", F.round("canopy_anom", 9)).drop("canopy_anom")


def repeated_quarters(cells: DataFrame) -> DataFrame:
    """Cells in which a quarter occurs twice: the screen refuses them."""
    return cells.groupBy(*CELL, "q").agg(F.count("*").alias("n")).filter("n > 1")


def resolution_audit(quarterly: DataFrame, features: list[str]) -> DataFrame:
    """Values present and different (to six places) of each series and feature, with a verdict."""
    long = quarterly.select(*SERIES, *(F.col(f).cast("double").alias(f) for f in features)).unpivot(SERIES, features, "feature", "v")
    out = long.groupBy(*SERIES, "feature").agg(F.count("v").alias("n_present"), F.count_distinct(F.round("v", 6)).alias("n_distinct"))
    return out.withColumn("verdict", stats.resolution_verdict(F.col("n_present"), F.col("n_distinct")))


def audit_note(audit: DataFrame, feature: str) -> DataFrame:
    """The series that a verdict other than ok touches, for one feature."""
    return audit.filter((F.col("feature") == feature) & (F.col("verdict") != "ok"))


def without_skipped(cells: DataFrame, audit: DataFrame) -> DataFrame:
    """Leave out the (series, feature) that the audit excludes."""
    skip = audit.filter(F.col("verdict").isin("not_applicable", "excluded")).select(F.col("source").alias("env_source"), "site_id", "parameter", "depth_m", F.concat("feature", F.lit("_anom")).alias("feature"))
    return null_safe_join(cells, skip.distinct(), [*ENV, "feature"], "left_anti")


def _lag1(column: str) -> Column:
    """Pearson's r of neighbours in calendar order; needs three adjacent pairs."""
    adjacent = F.col("q") - F.col("q_before") == 1
    x, b = F.when(adjacent, F.col(column)), F.when(adjacent, F.col(f"{column}_before"))
    return F.when(F.count_if(adjacent) >= MIN_ADJACENT, stats.pearson(x, b))


def screen(cells: DataFrame, least: int = MIN_PAIRS) -> DataFrame:
    """n, n_eff, discounted, r and rho of each cell with at least ``least`` pairs.

    Ranks, neighbours and sums come from one shuffle by cell. r and rho are rounded to
    three places and n_eff to one, and everything after reads the rounded figures. A
    cell in which a quarter occurs twice is refused.
    """
    w = W.partitionBy(*CELL).orderBy("q")
    ranked = (
        cells.withColumn("x_rank", stats.average_rank("x", *CELL)).withColumn("y_rank", stats.average_rank("y", *CELL))
        .withColumn("q_before", F.lag("q").over(w)).withColumn("x_before", F.lag("x").over(w)).withColumn("y_before", F.lag("y").over(w))
    )
    twice = F.bool_or(F.coalesce(F.col("q") == F.col("q_before"), F.lit(False)))
    out = ranked.groupBy(*CELL).agg(
        refused(twice, "a cell with a repeated quarter", F.count("*"), "long").alias("n"), stats.pearson(F.col("x"), F.col("y")).alias("r"), stats.pearson(F.col("x_rank"), F.col("y_rank")).alias("rho"),
        _lag1("x").alias("r1x"), _lag1("y").alias("r1y"),
    ).filter(F.col("n") >= least)
    return out.select(
        *CELL, "n", F.round(stats.effective_n(F.col("n"), F.col("r1x"), F.col("r1y")), 1).alias("n_eff"),
        stats.discounted(F.col("r1x"), F.col("r1y")).alias("discounted"), (F.round("r", 3) + 0.0).alias("r"), (F.round("rho", 3) + 0.0).alias("rho"),
    ).withColumn("rank_gap", F.round(F.abs(F.col("r") - F.col("rho")), 3))


def with_roles(cells: DataFrame, roles: dict[str, str]) -> DataFrame:
    """The role of each cell's parameter; one without a declared role is refused."""
    role = F.lit(None).cast("string")
    for p, r in roles.items():
        role = F.when(F.col("parameter") == p, F.lit(r)).otherwise(role)
    return cells.withColumn("role", refused(role.isNull(), "a parameter without a role", role, "string"))


def with_scales(cells: DataFrame) -> DataFrame:
    return cells.withColumn("z", stats.fisher_z(F.col("r"), F.col("n_eff"))).withColumn("bound", stats.lower_bound(F.col("r"), F.col("n_eff"))).withColumn(
        "disagreement", stats.disagreement(F.col("r"), F.col("rho"))
    )


SIGNAL = ["polygon_id", "feature", "lag"]
_KEY = [c for c in CELL if c not in SIGNAL]


def eligible(cells: DataFrame, gap: Column | float = 0.05, n_eff: float = 10.0) -> DataFrame:
    return cells.filter((F.col("n_eff") >= n_eff) & (F.col("rank_gap") <= gap) & F.col("r").isNotNull())


def signals(cells: DataFrame, *more: str) -> DataFrame:
    """The strongest cell of each signal; equal strength falls to the key."""
    order = [F.abs(F.col("r")).desc(), *(F.col(k).asc_nulls_last() for k in _KEY)]
    return cells.withColumn("rn", F.row_number().over(W.partitionBy(*more, *SIGNAL).orderBy(*order))).filter("rn = 1").drop("rn")


def top_signals(cells: DataFrame, k: int = 3) -> DataFrame:
    return signals(cells).orderBy(F.abs(F.col("r")).desc(), *(F.col(c).asc_nulls_last() for c in CELL)).limit(k)


def strongest(cells: DataFrame, k: int = 15, n_eff: float | None = None) -> DataFrame:
    """The k cells of largest size of r, of those with enough effective pairs."""
    kept = cells if n_eff is None else cells.filter(F.col("n_eff") >= n_eff)
    return kept.orderBy(F.abs(F.col("r")).desc_nulls_last(), *(F.col(c).asc_nulls_last() for c in CELL)).limit(k)


def members(cells: DataFrame, chosen: DataFrame) -> DataFrame:
    """Every cell of the chosen signals."""
    return cells.join(chosen.select(*SIGNAL).distinct(), SIGNAL, "left_semi")


def role_strength(cells: DataFrame) -> DataFrame:
    """Cells, largest and median size of r by role and parameter."""
    a = F.abs(F.col("r"))
    return cells.groupBy("role", "parameter").agg(F.count("*").alias("n_cells"), F.max(a).alias("max_abs_r"), F.median(a).alias("median_abs_r"))


def gate_ladder(cells: DataFrame, ceilings=(0.03, 0.05, 0.10, float("inf"))) -> DataFrame:
    """Eligible cells and signals under each ceiling of the rank gap, in one pass over the cells."""
    each = cells.withColumn("ceiling", F.explode(F.array(*map(F.lit, ceilings)))).filter((F.col("rank_gap") <= F.col("ceiling")) & (F.col("n_eff") >= 10))
    return each.groupBy("ceiling").agg(F.count("*").alias("n_cells"), F.count_distinct(F.struct(*SIGNAL)).alias("n_signals"))


def list_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Signals that drop out and that enter."""
    a, b = before.select(*SIGNAL), after.select(*SIGNAL)
    return a.exceptAll(b).withColumn("change", F.lit("drops out")).unionByName(b.exceptAll(a).withColumn("change", F.lit("enters")))


SCALES = ("abs_r", "z", "bound")


def scaled(signals_: DataFrame) -> DataFrame:
    """Signals with the size of r and its two standardised scales."""
    return with_scales(signals_).withColumn("abs_r", F.abs(F.col("r")))


def scale_ranks(signals_: DataFrame, role: str = "role") -> DataFrame:
    """Place of each signal of a role by each scale, ties at their mean place, cut to whole numbers.

    Signals are a pool of some hundreds (polygon x feature x lag); a role's are ranked together.
    """
    out = scaled(signals_)
    for c in SCALES:
        out = out.withColumn(f"__{c}", -F.col(c))
        out = out.withColumn(f"{c}_rank", stats.average_rank(f"__{c}", role).cast("int")).drop(f"__{c}")
    return out


def scale_leaders(ranked: DataFrame, k: int = 3) -> DataFrame:
    """The k signals of each role with the smallest place on each scale; equal places fall to the signal."""
    long = ranked.select("role", *SIGNAL, "r", "n_eff", *(F.col(f"{c}_rank").alias(c) for c in SCALES)).unpivot(["role", *SIGNAL, "r", "n_eff"], list(SCALES), "scale", "place")
    w = W.partitionBy("role", "scale").orderBy(F.col("place").asc_nulls_last(), *SIGNAL)
    return long.withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= k)


def scale_comparison(signals_: DataFrame) -> DataFrame:
    """Spearman's rho of each scale with n_eff over a pool of signals."""
    s = scaled(signals_)
    long = s.select("n_eff", *SCALES).unpivot(["n_eff"], list(SCALES), "scale", "v").filter("v is not null")
    ranked = long.withColumn("rv", stats.average_rank("v", "scale")).withColumn("rn", stats.average_rank("n_eff", "scale"))
    return ranked.groupBy("scale").agg(F.count("*").alias("n_signals"), F.round(stats.pearson(F.col("rv"), F.col("rn")), 6).alias("rho_n_eff"), F.max("v").alias("largest"))


def scale_pools(signals_: DataFrame, k: int = 3) -> DataFrame:
    """By role and scale: signals, largest n_eff and value, and how many reach the weakest registered signal.

    Registered are the k predictors of largest size of r; ``signals_`` has role.
    """
    s = scaled(signals_)
    top = s.filter("role = 'predictor'").orderBy(F.col("abs_r").desc(), *(F.col(c).asc_nulls_last() for c in CELL)).limit(k)
    weakest = top.select(*SCALES).unpivot([], list(SCALES), "scale", "v").groupBy("scale").agg(F.min("v").alias("weakest"))
    long = s.select("role", "n_eff", *SCALES).unpivot(["role", "n_eff"], list(SCALES), "scale", "v")
    return long.join(F.broadcast(weakest), "scale").groupBy("role", "scale").agg(  # three rows
        F.count("*").alias("n_signals"), F.max("n_eff").alias("max_n_eff"), F.max("v").alias("largest"),
        F.max("weakest").alias("weakest"), F.count_if(F.col("v") >= F.col("weakest")).alias("n_reaching"),
    )


def role_verdict(cells: DataFrame) -> DataFrame:
    """The largest size of r of either role and how the controls compare with the predictors."""
    a = F.abs(F.col("r"))
    best = cells.agg(F.max(F.when(F.col("role") == "predictor", a)).alias("predictor"), F.max(F.when(F.col("role") == "control", a)).alias("control"))
    more = F.col("control") - F.col("predictor")
    verdict = F.when(more.isNull(), "not comparable").when(F.abs(more) < 0.05, "as strongly as").when(more > 0, "more strongly than").otherwise("less strongly than")
    return best.withColumn("verdict", verdict)


def ladder_changes(cells: DataFrame, ceilings=(0.03, 0.05, 0.10, float("inf")), base: float = 0.05, k: int = 3) -> DataFrame:
    """Signals that drop out of the k strongest or enter them under each ceiling of the rank gap, against the base ceiling.

    All ceilings are ranked in one pass; ``base`` is one of them.
    """
    each = cells.withColumn("ceiling", F.explode(F.array(*map(F.lit, ceilings))))
    found = signals(eligible(each, F.col("ceiling")), "ceiling")
    order = [F.abs(F.col("r")).desc(), *(F.col(c).asc_nulls_last() for c in CELL)]
    top = found.withColumn("nth", F.row_number().over(W.partitionBy("ceiling").orderBy(*order))).filter(F.col("nth") <= k)
    under = top.groupBy(*SIGNAL).agg(F.collect_set("ceiling").alias("under"))
    in_base = F.array_contains("under", F.lit(base))
    out = under.select(*SIGNAL, in_base.alias("in_base"), "under", F.explode(F.array(*map(F.lit, ceilings))).alias("ceiling"))
    there = F.array_contains("under", F.col("ceiling"))
    return out.filter(there != F.col("in_base")).select(*SIGNAL, F.when(there, "enters").otherwise("drops out").alias("change"), "ceiling")


def pairs_of(cells: DataFrame, chosen: DataFrame) -> DataFrame:
    """The quarters behind screened cells, on the whole key, null depths equal; a count that differs from the screen's n is refused."""
    sized = null_safe_join(cells, chosen.select(*CELL, "n"), CELL, "inner").withColumn("found", F.count("*").over(W.partitionBy(*CELL)))
    same = refused(F.col("found") != F.col("n"), "a cell rebuilt from other quarters", F.col("q"), "int")
    return sized.select(*CELL, same.alias("q"), "x", "y")


# --- series of the response and of the predictors ----------------------------------------------


#: Cells whose dense vectors are handled at once.
VECTORS = 512


def _dense(rows: Sequence, columns: tuple[str, ...]) -> list[np.ndarray]:
    """A matrix of each column, a row for each list of (q, columns), NaN where a quarter is absent; a repeated quarter is refused."""
    first = [min(r["q"] for r in row) for row in rows]
    width = max(max(r["q"] for r in row) - f + 1 for row, f in zip(rows, first, strict=True))
    out = [np.full((len(rows), width), np.nan) for _ in columns]
    for i, (row, f) in enumerate(zip(rows, first, strict=True)):
        at = np.array([r["q"] - f for r in row])
        if len(np.unique(at)) < len(at):
            raise ValueError("refused: a series with a repeated quarter")
        for m, c in zip(out, columns, strict=True):
            m[i, at] = [np.nan if r[c] is None else r[c] for r in row]
    return out


def _lagged_r(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of quarters k apart in each row, and Pearson's r over them (NaN where a side is flat)."""
    if k >= v.shape[1]:
        return np.zeros(len(v), int), np.full(len(v), np.nan)
    a, b = v[:, k:], v[:, :-k]
    both = ~np.isnan(a) & ~np.isnan(b)
    n = both.sum(1)
    size = np.maximum(n, 1)
    centred = [np.where(both, x - (np.where(both, x, 0).sum(1) / size)[:, None], 0) for x in (a, b)]
    spread = np.sqrt((centred[0] ** 2).sum(1) / size) * np.sqrt((centred[1] ** 2).sum(1) / size)
    return n, np.where(spread > 1e-12, (centred[0] * centred[1]).sum(1) / size / np.where(spread > 1e-12, spread, 1), np.nan)


def autocorrelation(series: DataFrame, keys: list[str], value: str, lags: list[int]) -> DataFrame:
    """r at each lag over pairs exactly that many quarters apart, where there are any; r needs three pairs.

    ``series`` has the keys, q and the value. A series is gathered once, as a dense vector
    of its quarters, and all lags are read from it.
    """
    rows = series.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.collect_list(F.struct("q", F.col(value).alias("v"))).alias("quarters"))

    @F.pandas_udf("array<struct<k: int, n_pairs: bigint, r_k: double>>")
    def lagged(quarters: pd.Series) -> pd.Series:
        out: list[list] = []
        for at in range(0, len(quarters), VECTORS):
            (v,) = _dense(list(quarters[at : at + VECTORS]), ("v",))
            found = [(k, *_lagged_r(v, k)) for k in lags]
            out += [[{"k": k, "n_pairs": n[i], "r_k": r[i] if n[i] >= MIN_ADJACENT and r[i] == r[i] else None} for k, n, r in found if n[i]] for i in range(len(v))]
        return pd.Series(out, dtype=object)

    return rows.select(*keys, F.inline(lagged("quarters")))


def bartlett_sweep(cells: DataFrame, truncations: Sequence[int | None] = (4, 8, 12, 16)) -> DataFrame:
    """Effective size of each cell by Bartlett's sum to each lag K of ``truncations`` (None: a quarter of n).

    ``n / (1 + 2 * sum((1 - k/n) * rx_k * ry_k))``; null if any r_k is unknown or the
    denominator is not positive. A cell's quarters, some two hundred, are gathered
    once, and all lags of all K are read from their dense vectors.
    """
    rows = cells.groupBy(*CELL).agg(F.count("*").alias("n"), F.collect_list(F.struct("q", "x", "y")).alias("quarters"))

    @F.pandas_udf("array<struct<k_max: int, n_eff_bartlett: double>>")
    def sized(quarters: pd.Series) -> pd.Series:
        out: list[list] = []
        for at in range(0, len(quarters), VECTORS):
            part = list(quarters[at : at + VECTORS])
            x, y = _dense(part, ("x", "y"))
            n = np.array([len(p) for p in part])
            last = np.array([[n_i // 4 if k is None else k for k in truncations] for n_i in n])
            found, total, known = np.zeros(last.shape), np.zeros(last.shape), np.ones(last.shape, bool)
            for k in range(1, int(last.max(initial=0)) + 1):
                pairs, rx = _lagged_r(x, k)
                p = np.where(pairs >= MIN_ADJACENT, rx * _lagged_r(y, k)[1], np.nan)[:, None]
                counts = last >= k
                found += np.where(counts, pairs[:, None], 0)
                known &= ~counts | ~np.isnan(p)
                total += np.where(counts & ~np.isnan(p), (1 - k / n)[:, None] * np.nan_to_num(p), 0)
            d = 1 + 2 * total
            size = np.where(known & (d > 0), np.maximum(n[:, None] / np.where(d > 0, d, 1), 1.0), np.nan)
            out += [[{"k_max": int(last[i, j]), "n_eff_bartlett": None if np.isnan(size[i, j]) else size[i, j]} for j in range(len(truncations)) if last[i, j] >= 1 and found[i, j]] for i in range(len(part))]
        return pd.Series(out, dtype=object)

    return rows.select(*CELL, "n", F.inline(sized("quarters")))


def bartlett(cells: DataFrame, truncation: int | None = None) -> DataFrame:
    """:func:`bartlett_sweep` for one truncation, a quarter of n unless given."""
    return bartlett_sweep(cells, (truncation,))


def response_shape(canopy: DataFrame, value: str = "area_m2") -> DataFrame:
    """Quarters, zeros, different values and adjusted skew of each polygon's response."""
    v = F.col(value)
    return canopy.filter(v.isNotNull()).groupBy("polygon_id").agg(
        F.count("*").alias("n_quarters"), F.count_if(v == 0).alias("n_zero"), (F.count_if(v == 0) / F.count("*")).alias("zero_share"),
        F.count_distinct(v).alias("n_distinct"), stats.adjusted_skew(v).alias("skew"), F.count_if(v > 0).alias("n_nonzero"),
    )


def leverage(canopy: DataFrame, value: str, fraction: float = 0.05) -> DataFrame:
    """Share of the squared deviations that the round(fraction * n) largest have."""
    w = W.partitionBy("polygon_id")
    d = canopy.filter(F.col(value).isNotNull()).withColumn("d2", F.pow(F.col(value) - F.avg(value).over(w), 2)).withColumn("n", F.count("*").over(w))
    d = d.withColumn("rn", F.row_number().over(W.partitionBy("polygon_id").orderBy(F.col("d2").desc(), "year", "quarter")))
    top = F.col("rn") <= F.bround(F.col("n") * fraction)
    return d.groupBy("polygon_id").agg(F.try_divide(F.sum(F.when(top, F.col("d2")).otherwise(0.0)), F.sum("d2")).alias("leverage"))


def series_name() -> Column:
    return F.concat_ws("|", "source", "site_id", "parameter", F.coalesce(F.col("depth_m").cast("string"), F.lit("-")))


def _gram(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common quarters and Pearson's r of every row of ``a`` with every row of ``b`` (NaN: absent), by matrix products."""
    masks = [(~np.isnan(m)).astype(float) for m in (a, b)]
    # about a row's own mean, which r does not see, so that sums of squares lose nothing
    x, y = (np.nan_to_num(m - (np.nan_to_num(m).sum(1) / np.maximum(w.sum(1), 1))[:, None]) for m, w in zip((a, b), masks, strict=True))
    n = masks[0] @ masks[1].T
    size = np.maximum(n, 1)
    sx, sy = x @ masks[1].T / size, masks[0] @ y.T / size
    vx, vy = (x * x) @ masks[1].T / size - sx * sx, masks[0] @ (y * y).T / size - sy * sy
    spread = np.sqrt(np.maximum(vx, 0)) * np.sqrt(np.maximum(vy, 0))
    return n.astype(int), np.where(spread > 1e-12, (x @ y.T / size - sx * sy) / np.where(spread > 1e-12, spread, 1), np.nan)


#: Series of a block on either side of :func:`redundancy`.
GRAM = 256


def redundancy(quarterly: DataFrame, column: str, least: int = 8) -> DataFrame:
    """Pairwise-complete r between series of one anomaly, with their common quarters.

    A series' values, one for each quarter, are gathered once. Series meet in blocks of
    about GRAM on either side, dealt by a hash of their names; counts, sums and products of
    a block come from matrix products of its dense vectors and their masks. The pairs
    with a common quarter are the result. Two values of a series in one quarter are refused.
    """
    q = calendar.quarter_index(F.col("year"), F.col("quarter"))
    s = quarterly.filter(F.col(column).isNotNull()).groupBy(series_name().alias("a")).agg(F.collect_list(F.struct(q.alias("q"), F.col(column).alias("v"))).alias("quarters"))
    s = written(s, "series")
    n_blocks = max(1, -(-s.count() // GRAM))
    s = s.withColumn("block", F.pmod(F.xxhash64("a"), F.lit(n_blocks)).cast("int"))
    left = s.select(F.col("a").alias("name"), F.col("quarters").alias("cells"), F.col("block").alias("i"), F.explode(F.sequence("block", F.lit(n_blocks - 1))).alias("j"))
    right = s.select(F.col("a").alias("name"), F.col("quarters").alias("cells"), F.explode(F.sequence(F.lit(0), "block")).alias("i"), F.col("block").alias("j"))

    def meet(key: tuple, x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"a": [], "b": [], "n_common": [], "r": []})
        if x.empty or y.empty:
            return none
        spans = [np.array([r["q"] for row in f["cells"] for r in row]) for f in (x, y)]
        low, width = min(v.min() for v in spans), max(v.max() for v in spans) - min(v.min() for v in spans) + 1
        dense = []
        for f in (x, y):
            m = np.full((len(f), width), np.nan)
            for i, row in enumerate(f["cells"]):
                at = np.array([r["q"] for r in row]) - low
                if len(np.unique(at)) < len(at):
                    raise ValueError("refused: a series with two values in a quarter")
                m[i, at] = [r["v"] for r in row]
            dense.append(m)
        n, r = _gram(*dense)
        names = [f["name"].to_numpy(object) for f in (x, y)]
        same = names[0][:, None] == names[1][None]
        i, j = np.nonzero((n > 0) & ~same & ((names[0][:, None] < names[1][None]) | (key[0] != key[1])))
        a, b = names[0][i], names[1][j]
        lower = a < b
        r = np.where(n[i, j] >= least, r[i, j], np.nan)
        return pd.DataFrame({"a": np.where(lower, a, b), "b": np.where(lower, b, a), "n_common": n[i, j], "r": pd.Series(r).astype(object).where(~np.isnan(r), None)})

    return left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInPandas(meet, "a string, b string, n_common long, r double")


#: Blocks of series on either side of :func:`overlap_change`.
BLOCKS = 8


def overlap_change(gated: DataFrame, column: str) -> DataFrame:
    """Pairs of series whose common predictor quarters differ between all lags and lag 0 alone."""
    rows = gated.filter(F.coalesce("env_usable", F.lit(False)) & F.col(column).isNotNull())
    quarters = rows.groupBy(series_name().alias("a"), calendar.quarter_index(F.col("env_year"), F.col("env_quarter")).alias("q")).agg(F.max((F.col("lag") == 0).cast("int")).alias("zero"))
    s = quarters.groupBy("a").agg(F.collect_set("q").alias("any_q"), F.collect_set(F.when(F.col("zero") == 1, F.col("q"))).alias("zero_q"))
    s = s.withColumn("block", F.pmod(F.xxhash64("a"), F.lit(BLOCKS)).cast("int"))
    every = F.sequence(F.lit(0), F.lit(BLOCKS - 1))
    left = s.select("a", "any_q", "zero_q", F.col("block").alias("i"), F.explode(every).alias("j"))
    right = s.select(F.col("a").alias("b"), F.col("any_q").alias("any_b"), F.col("zero_q").alias("zero_b"), F.col("block").alias("j"), F.explode(every).alias("i"))
    size = lambda x, y: F.size(F.array_intersect(x, y)).cast("long")
    return left.join(right, ["i", "j"]).filter("a < b").select("a", "b", size("any_q", "any_b").alias("any_lag"), size("zero_q", "zero_b").alias("lag_0")).filter("any_lag <> lag_0")


def quarter_matrix(quarterly: DataFrame, column: str, series: list[str]) -> DataFrame:
    """Quarters (rows) by series (columns) of one figure.

    Two values of a series in one quarter are refused, and so is a value of a series that is not listed.
    """
    name = series_name()
    name = refused(~name.isin(*series), "a series that is no column of the matrix", name, "string")
    rows = quarterly.filter(F.col(column).isNotNull()).select("year", "quarter", name.alias("series"), F.col(column).alias("v"))
    repeated = F.raise_error(F.lit("refused: a series with two values in a quarter")).cast("double")
    return rows.groupBy("year", "quarter").pivot("series", series).agg(F.when(F.count(F.lit(1)) > 1, repeated).otherwise(F.max("v")))


def remeasurement(quarterly: DataFrame, column: str) -> DataFrame:
    """r between the parameters of a station over the quarters in which all are present, beside the pairwise r.

    A station's parameters, one mean for each quarter, form one small matrix.
    """
    q = calendar.quarter_index(F.col("year"), F.col("quarter"))
    s = quarterly.filter(F.col(column).isNotNull()).groupBy("site_id", "parameter", q.alias("q")).agg(F.avg(column).alias("x"))

    def pairs(part: pd.DataFrame) -> pd.DataFrame:
        m = part.pivot(index="parameter", columns="q", values="x").sort_index()
        v = m.to_numpy(float)
        n, r = _gram(v, v)
        whole = np.where(np.isnan(v).any(0), np.nan, v)
        n_all, r_all = _gram(whole, whole)
        i, j = np.nonzero(np.triu(n > 0, 1))
        null = lambda x: pd.Series(x).astype(object).where(~np.isnan(x), None)
        return pd.DataFrame({
            "site_id": part.site_id.iloc[0], "a": m.index[i], "b": m.index[j], "n_pairwise": n[i, j], "r_pairwise": null(r[i, j]), "n_listwise": n_all[i, j], "r_listwise": null(r_all[i, j]),
        })

    return s.groupBy("site_id").applyInPandas(pairs, "site_id string, a string, b string, n_pairwise long, r_pairwise double, n_listwise long, r_listwise double")


def lag_feature_matrix(cells: DataFrame, lags=(0, 1, 2, 3, 4)) -> DataFrame:
    """r by feature (rows) and lag (columns) of every series and polygon; a repeated cell is refused."""
    keys = [c for c in CELL if c != "lag"]
    repeated = F.raise_error(F.lit("a series has two cells of one feature and lag")).cast("double")
    return cells.groupBy(*keys).pivot("lag", list(lags)).agg(F.when(F.count(F.lit(1)) > 1, repeated).otherwise(F.max("r")))


def lag_profiles(cells: DataFrame, lags=(0, 1, 2, 3, 4)) -> DataFrame:
    """r at each lag as an array, null where the screen has no cell."""
    keys = [c for c in CELL if c != "lag"]
    m = cells.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("lag", "r"))).alias("m"))
    return m.select(*keys, F.transform(F.array(*map(F.lit, lags)), lambda k: F.try_element_at(F.col("m"), k)).alias("profile"))
