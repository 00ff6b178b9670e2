"""Parsing of single fields: units, sentinels, positions, intervals and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spellings of units, letters and digits only, and the unit they mean.
UNIT_ALIASES = {
    "degf": "degF", "f": "degF", "fahrenheit": "degF", "degc": "degC", "c": "degC", "celsius": "degC", "degreec": "degC",
    "s": "s", "sec": "s", "seconds": "s", "ms": "m s-1", "ms1": "m s-1", "m": "m", "meters": "m",
}


def unit_of(header: Column) -> Column:
    folded = F.regexp_replace(F.lower(header), "[^a-z0-9]", "")
    table = F.create_map(*[F.lit(x) for kv in UNIT_ALIASES.items() for x in kv])
    return F.try_element_at(table, folded)


def convert(value: Column, header: Column, target: str) -> Column:
    """The value in the target unit; null where the units do not fit (see :func:`unit_refused`)."""
    unit = unit_of(header)
    if target == "degC":
        return F.when(unit == "degC", value).when(unit == "degF", (value - 32) * 5 / 9)
    return F.when(unit == target, value)


def unit_refused(header: Column, target: str) -> Column:
    fits = (target, "degF") if target == "degC" else (target,)
    return ~F.coalesce(unit_of(header).isin(*fits), F.lit(False))


def number(text: Column, sentinel: float | None = None, missing: str = "MM") -> Column:
    """A number, or null for the missing mark, the sentinel, NaN and what cannot be read."""
    x = F.expr("null").cast("double") if text is None else F.nanvl(text.try_cast("double"), F.lit(None).cast("double"))
    return x if sentinel is None else F.nullif(x, F.lit(float(sentinel)))


def unreadable(text: Column, missing: str = "MM") -> Column:
    return text.isNotNull() & text.try_cast("double").isNull() & (F.trim(text) != missing)


def five_column_time(y: Column, m: Column, d: Column, h: Column, minute: Column) -> Column:
    return F.try_make_timestamp_ntz(*(c.try_cast("int") for c in (y, m, d, h, minute)), F.lit(0).cast("decimal(16,6)"))


def dms(text: Column) -> Column:
    """Degrees, minutes, seconds and a hemisphere letter as decimal degrees."""
    part = lambda i: F.coalesce(F.regexp_extract(text, r"(\d+)\D+(\d+)\D+([\d.]+)\D*([NSEW])", i).try_cast("double"), F.lit(None))
    size = part(1) + part(2) / 60 + part(3) / 3600
    return F.when(F.regexp_extract(text, r"([NSEW])\s*$", 1).isin("S", "W"), -size).otherwise(size)


def position_matches(lat: Column, lon: Column, site_lat: Column, site_lon: Column, tolerance: float = 0.0005) -> Column:
    return (F.abs(lat - site_lat) <= tolerance) & (F.abs(lon - site_lon) <= tolerance)


def interval_seconds(text: Column) -> Column:
    """``0 hour 10 minutes 0 seconds`` as seconds; null without a known part."""
    pairs = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(r"(\d+)\s*(hour|minute|second)"), 1).alias("n"),
        F.regexp_extract_all(text, F.lit(r"(\d+)\s*(hour|minute|second)"), 2).alias("u"),
    )
    factor = lambda u: F.when(u == "hour", 3600).when(u == "minute", 60).otherwise(1)
    total = F.aggregate(pairs, F.lit(0).cast("long"), lambda acc, p: acc + p["n"].cast("long") * factor(p["u"]))
    return F.when(F.size(pairs) > 0, total)


def file_parts(name: Column) -> tuple[Column, Column, Column]:
    """Name, serial and readout of ``name__serial__readout.ext``."""
    parts = F.split(F.regexp_replace(name, r"\.[^.]*$", ""), "__")
    return tuple(F.get(parts, i) for i in range(3))


def depth_of_altitude(z: Column) -> Column:
    """Depth below the surface; a positive altitude is refused."""
    return refused(z > 0, "a positive altitude", -z, "double")


def refused(bad: Column, what: str, value: Column, kind: str) -> Column:
    """``value``, or an error where ``bad`` holds."""
    return F.when(bad, F.raise_error(F.lit(f"refused: {what}")).cast(kind)).otherwise(value)


def canopy_missing(value: Column, observed_cells: Column) -> Column:
    """An unobserved quarter has no value, which is not zero."""
    return F.when(observed_cells > 0, value)
