"""Quarters, local clocks and windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quarter_start(ts: Column) -> Column:
    return F.date_trunc("quarter", ts).cast("timestamp_ntz")


def quarter_end(start: Column) -> Column:
    return F.add_months(start, 3).cast("timestamp_ntz")


def quarter_label(year: Column, quarter: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("Q"), quarter.cast("string"))


def quarter_index(year: Column, quarter: Column) -> Column:
    """A running number of quarters."""
    return (year * 4 + quarter - 1).cast("int")


def from_index(index: Column) -> tuple[Column, Column]:
    return F.floor(index / 4).cast("int"), (F.pmod(index, F.lit(4)) + 1).cast("tinyint")


def shift_quarter(year: Column, quarter: Column, by: Column | int) -> tuple[Column, Column]:
    return from_index(quarter_index(year, quarter) + by)


def is_complete(end: Column, now: str) -> Column:
    """A window is complete once it has ended by ``now``, which is always an argument."""
    return end <= F.lit(now).cast("timestamp_ntz")


def seconds(interval_end: Column, interval_start: Column) -> Column:
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    return (micros(interval_end) - micros(interval_start)) / F.lit(1e6)


def to_utc_at_first(local: Column, first: Column, zone: Column) -> Column:
    """Local to UTC with the one offset that holds at the file's first sample."""
    offset = seconds(F.to_utc_timestamp(first, zone), first)
    return local + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), offset.cast("decimal(18,6)"))


def window_utc(start: Column, end: Column, zone: Column) -> tuple[Column, Column]:
    """A closed local window in UTC; null if either end or the zone is undeclared."""
    both = start.isNotNull() & end.isNotNull() & zone.isNotNull()
    to = lambda c: F.when(both, F.to_utc_timestamp(c, zone).cast("timestamp_ntz"))
    return to(start), to(end)


def clock(hhmm: Column, default: int = 1038) -> Column:
    """Minutes of an HHMM integer without leading zeros; null means the default, nonsense is null."""
    t = F.coalesce(hhmm, F.lit(default)).cast("int")
    minutes = F.floor(t / 100) * 60 + F.pmod(t, F.lit(100))
    return F.when((t >= 0) & (t < 2400) & (F.pmod(t, F.lit(100)) < 60), minutes.cast("int"))
