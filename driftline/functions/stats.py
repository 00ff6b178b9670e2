"""Statistics that are safe on flat and short groups, and null-safe joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def pearson(x: Column, y: Column) -> Column:
    """Pearson's r over complete pairs; null where a side is flat."""
    xx, yy = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    spread = F.stddev_pop(xx) * F.stddev_pop(yy)
    return F.try_divide(F.covar_pop(xx, yy), F.when(spread > 1e-12, spread))


def average_rank(value: str, *keys: str) -> Column:
    """Rank from 1, ties sharing the mean of their ranks; rows without a value have none."""
    order = W.partitionBy(*keys, F.col(value).isNull()).orderBy(value)
    tie = W.partitionBy(*keys, value)
    return F.when(F.col(value).isNotNull(), F.rank().over(order) + (F.count("*").over(tie) - 1) / 2)


def effective_n(n: Column, r1x: Column, r1y: Column) -> Column:
    """Sample size after the lag-1 discount; no discount where p is unknown or not positive; 1 at least."""
    p = F.round(r1x * r1y, 9)  # nine places: nothing of rounding counts as persistence
    return F.when(p.isNull() | (p <= 0), n.cast("double")).otherwise(F.greatest(n * (1 - p) / (1 + p), F.lit(1.0)))


def discounted(r1x: Column, r1y: Column) -> Column:
    return F.coalesce(F.round(r1x * r1y, 9) > 0, F.lit(False))


def resolution_verdict(present: Column, distinct: Column) -> Column:
    return (
        F.when(present == 0, "not_applicable").when(distinct < 10, "excluded").when(distinct < 25, "low_resolution").otherwise("ok")
    )


def disagreement(r: Column, rho: Column) -> Column:
    return (
        F.when(r * rho < 0, "sign differs").when(F.abs(r) > F.abs(rho), "Pearson larger")
        .when(F.abs(r) < F.abs(rho), "Spearman larger").otherwise("equal")
    )


def _fisher_room(n_eff: Column) -> Column:
    return F.when(n_eff > 3, F.sqrt(n_eff - 3))


def fisher_z(r: Column, n_eff: Column) -> Column:
    return F.abs(F.atanh(r)) * _fisher_room(n_eff)


def lower_bound(r: Column, n_eff: Column) -> Column:
    """Lower end of the 95 % interval of the size of r, not below 0; null where n_eff is 3 at most."""
    low = F.abs(F.atanh(r)) - 1.96 / _fisher_room(n_eff)
    return F.when(low.isNotNull(), F.tanh(F.greatest(low, F.lit(0.0))))


def adjusted_skew(x: Column) -> Column:
    n = F.count(x)
    flat = F.coalesce(F.max(x) == F.min(x), F.lit(True))
    return F.when((n > 2) & ~flat, F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))


def depth_gap(a: Column, b: Column) -> Column:
    return F.abs(a - b)


def depth_comparable(a: Column, b: Column, tolerance: float) -> Column:
    return F.coalesce(depth_gap(a, b) <= tolerance, F.lit(False))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on keys whose nulls match each other; the right side's keys are dropped."""
    named = right.select(*(F.col(c).alias(f"__{c}") if c in keys else F.col(c) for c in right.columns))
    on = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"__{k}"))
        on = same if on is None else on & same
    return left.join(named, on, how).drop(*(f"__{k}" for k in keys))


def exact_mean(value: Column) -> Column:
    """The mean of a group to nine places, from the sum of its values as decimals of nine, which no order of the rows changes.

    A group with a value beyond such decimals (an infinity, 19 digits before the point) takes the plain average.
    """
    exact = value.try_cast("decimal(28,9)")
    return F.when(F.count(exact) == F.count(value), F.round(F.sum(exact).cast("double") / F.count(value), 9)).otherwise(F.avg(value))
