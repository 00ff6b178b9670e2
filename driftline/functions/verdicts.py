"""Quality verdicts: packed text, maps, roll-up into one flag, and filters on it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASS, NOT_EVALUATED, SUSPECT, FAIL, MISSING = 1, 2, 3, 4, 9
STATUS = {"pass": PASS, "suspect": SUSPECT, "fail": FAIL, "missing": MISSING}
#: Tests in the order they are written; others follow by name.
ORDER = ("deployment_window", "gross_range", "spike", "rate_of_change")


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _fragments(packed: Column) -> Column:
    """The fragments between ``;`` that hold something, as structs of name and status; no ``:`` gives no status."""
    parts = F.transform(F.split(F.coalesce(packed, F.lit("")), ";"), lambda x: F.trim(x, F.lit(" \t\n\r\x0b\x0c")))
    name = lambda x: F.substring_index(x, ":", 1)
    status = lambda x: F.when(F.contains(x, F.lit(":")), F.substring(x, F.length(name(x)) + 2, F.length(x)))
    return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.struct(name(x).alias("name"), status(x).alias("status")))


def parse(packed: Column) -> Column:
    """``name:status;name:status`` as a map; null and empty text give an empty map, of a repeated name the last counts."""
    def last(f: Column) -> Column:
        return F.filter(f, lambda x, i: ~F.exists(F.slice(f, i + 2, F.greatest(F.size(f) - i - 1, F.lit(0))), lambda y: y["name"] == x["name"]))

    return F.map_from_entries(_once(_fragments(packed), last))


def malformed(packed: Column) -> Column:
    """True where a fragment has no name or no known status."""
    return F.exists(_fragments(packed), lambda e: ~F.coalesce(e["status"].isin(*STATUS), F.lit(False)) | (e["name"] == ""))


def readable(packed: Column) -> Column:
    """``packed``, refused where a fragment has no name or no known status."""
    bad = (F.coalesce(packed, F.lit("")) != "") & malformed(packed)
    return F.when(bad, F.raise_error(F.concat(F.lit("unreadable verdicts: "), packed))).otherwise(packed)


def rollup(statuses: Column) -> Column:
    """The flag of an array of statuses: missing, then fail, suspect, pass, else not evaluated."""
    def flag(found: Column) -> Column:
        has = lambda s: F.array_contains(found, s)
        return (
            F.when(has("missing"), MISSING).when(has("fail"), FAIL).when(has("suspect"), SUSPECT)
            .when(has("pass"), PASS).otherwise(NOT_EVALUATED).cast("tinyint")
        )

    return _once(statuses, flag)


def describe(verdicts: Column) -> Column:
    """A map of verdicts as text: known tests in their order, others by name, no-verdicts left out."""
    rank = F.create_map(*[x for i, t in enumerate(ORDER) for x in (F.lit(t), F.lit(i))])
    entries = F.map_entries(F.map_filter(verdicts, lambda k, v: v.isNotNull()))
    keyed = F.transform(
        entries, lambda e: F.struct(F.coalesce(F.try_element_at(rank, e["key"]), F.lit(len(ORDER))).alias("r"), e["key"].alias("k"), e["value"].alias("v"))
    )
    return F.array_join(F.transform(F.sort_array(keyed), lambda e: F.concat(e["k"], F.lit(":"), e["v"])), ";")


def merged(packed: Column, foreign: Column, own: dict[str, Column]) -> tuple[Column, Column]:
    """Flag and text of ``own`` verdicts by name and ``foreign``, a map of what other stages packed.

    ``own`` names tests of ORDER, in that order. The map is looked at only where ``packed``
    holds something, so rows without foreign verdicts cost no maps or arrays.
    """
    some = F.coalesce(packed, F.lit("")) != ""
    flag = F.lit(NOT_EVALUATED)
    for status in ("pass", "suspect", "fail", "missing"):
        mine = F.lit(False)
        for verdict in own.values():
            mine = mine | F.coalesce(verdict == status, F.lit(False))
        theirs = F.when(some, F.coalesce(F.array_contains(F.map_values(foreign), status), F.lit(False))).otherwise(F.lit(False))
        flag = F.when(mine | theirs, STATUS[status]).otherwise(flag)
    first = ORDER[: ORDER.index(next(iter(own)))]
    parts = [F.when(some, F.concat(F.lit(f"{t}:"), F.try_element_at(foreign, F.lit(t)))) for t in first]
    parts += [F.concat(F.lit(f"{t}:"), verdict) for t, verdict in own.items()]
    rest = F.when(some, F.nullif(describe(F.map_filter(foreign, lambda k, _: ~k.isin(*first))), F.lit("")))
    return flag.cast("tinyint"), F.concat_ws(";", *parts, rest)


def decode_digits(digits: Column, names: tuple[str, ...]) -> Column:
    """A provider's verdict string, one digit for each test, as a map; 2 is left out, a wrong length gives none."""
    status = F.create_map(*[F.lit(x) for x in ("1", "pass", "3", "suspect", "4", "fail", "9", "missing")])
    values = F.transform(F.split(digits, ""), lambda d: F.try_element_at(status, d))
    whole = F.map_from_arrays(F.array(*map(F.lit, names)), values)
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return F.when(F.length(digits) == len(names), F.map_filter(whole, lambda k, v: v.isNotNull())).otherwise(empty)


def ingest_flag(value: Column) -> Column:
    """9 for an absent value, else 2."""
    return F.when(value.isNull(), MISSING).otherwise(NOT_EVALUATED).cast("tinyint")


def usable(df: DataFrame, most: int = NOT_EVALUATED) -> DataFrame:
    """Rows with a value and a flag of ``most`` at most."""
    return df.filter((F.col("qc_flag") <= most) & F.col("value").isNotNull())


def source_code_status(code: Column) -> Column:
    """Status of an archive's flag code: 0 pass, 1 to 4 suspect, 5 fail; null has none, another code is refused."""
    return (
        F.when(code == 0, "pass").when(code.between(1, 4), "suspect").when(code == 5, "fail")
        .when(code.isNotNull(), F.raise_error(F.concat(F.lit("unknown flag code "), code.cast("string"))))
    )
