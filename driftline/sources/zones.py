"""Stored observations and feature tables: reads, merges, replacements, fingerprints and audit records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from driftline.operators.checks import observation_faults
from driftline.sources import snapshots

IDENTITY = ["site_id", "parameter", "timestamp", "depth_m"]
OBSERVATION = (
    "timestamp timestamp_ntz, site_id string, parameter string, value double, depth_m double, qc_flag tinyint, qc_tests string, source string, fetch_run_id string"
)
TABLES = ("quarterly_env", "quarterly_canopy", "climatology_env", "climatology_canopy", "comparison", "validation", "deployment", "deployment_daily", "deployment_hourly")

#: New rows of a partition (source, year) that one file holds on average at most; a larger partition has more files.
FILE_ROWS = 1 << 20


def dedupe(obs: DataFrame, arrival: str | None = None) -> DataFrame:
    """One row for each identity and source: the newest run, of equals the later arrival. Null depths are equal.

    Without an arrival column the value decides among equals, so the result is fixed.
    """
    last = F.col(arrival).desc() if arrival else F.col("value").desc_nulls_last()
    w = W.partitionBy("source", *IDENTITY).orderBy(F.col("fetch_run_id").desc(), last)
    return obs.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    df = snapshots.read(spark, path, schema)
    return spark.createDataFrame([], schema) if df is None else df


def read_observations(spark: SparkSession, root: str, source: str | None = None, years: tuple[int, int] | None = None) -> DataFrame:
    """Stored observations, of one source and a range of years if given; both prune partitions.

    They are as the newest snapshot names them, one row for each identity, since every
    merge leaves one.
    """
    df = _stored(spark, root, OBSERVATION + ", year int")
    df = df if source is None else df.filter(F.col("source") == source)
    df = df if years is None else df.filter(F.col("year").between(*years))
    return df.select(*(c.split()[0] for c in OBSERVATION.split(", ")))


def write_observations(new: DataFrame, root: str) -> None:
    """Merge rows into the partitions (source, year) that they touch, as one snapshot.

    Rows that are not of the stored shape are refused before anything is written: columns
    of another name, order or type, a flag that is none, a value that is no number. What is
    stored arrives first, so a tie of runs falls to the new rows. An empty frame writes
    nothing. Untouched partitions are neither read nor written; readers see all of
    the merge or none of it.
    """
    spark = new.sparkSession
    if faults := observation_faults(new, _parse_datatype_string(OBSERVATION)):
        raise ValueError(f"not observations: {', '.join(f'{n} {k}' for k, n in faults.items())}")
    new = new.withColumn("year", F.year("timestamp"))
    touched: dict[str | None, list[int]] = {}
    most = 0
    for source, year, n in new.groupBy("source", "year").agg(F.count("*").alias("n")).collect():  # partitions
        touched.setdefault(source, []).append(year)
        most = max(most, n)
    if not touched:
        return
    base = snapshots.current(spark, root)
    every = new.withColumn("__arrival", F.lit(1))
    old = snapshots.read(spark, root, OBSERVATION + ", year int", base) if base else None
    if old is not None:
        among = F.lit(False)
        for source, years in touched.items():
            among = among | (F.col("source").eqNullSafe(F.lit(source)) & F.col("year").isin(years))
        every = every.unionByName(old.filter(among).withColumn("__arrival", F.lit(0)))
    merged = dedupe(every, "__arrival").drop("__arrival")
    # a partition is written by as many tasks as its rows ask for, dealt by identity, so neither a long year nor a few sites make one task's work grow
    files = -(-most // FILE_ROWS)
    part = ["source", "year", F.pmod(F.xxhash64(*IDENTITY), F.lit(files))]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), files * sum(map(len, touched.values())))
    merged = merged.repartition(tasks, *part).sortWithinPartitions("source", "year", *IDENTITY)
    snapshots.commit(merged, root, base, ("source", "year"))


def _table(root: str, table: str) -> str:
    if table not in TABLES:
        raise ValueError(f"no table is called {table}")
    return f"{root.rstrip('/')}/{table}"


def read_features(spark: SparkSession, root: str, table: str, schema: str) -> DataFrame:
    """A feature table, empty with its schema if it was never built. Unknown names are refused."""
    return _stored(spark, _table(root, table), schema)


def replace_features(df: DataFrame, root: str, table: str, key: list[str]) -> None:
    """Write a whole table anew, sorted by its key, nulls last; readers see the old table until the new one is whole."""
    path = _table(root, table)
    base = snapshots.current(df.sparkSession, path)
    snapshots.commit(df.sort(*(F.col(k).asc_nulls_last() for k in key)), path, base)


def write_features(df: DataFrame, root: str, table: str, key: list[str], replacing: list[str]) -> None:
    """Replace the rows of the rebuilt sources; others are kept in the new table's columns."""
    path = _table(root, table)
    base = snapshots.current(df.sparkSession, path)
    old = snapshots.read(df.sparkSession, path, snapshot=base) if base else None
    if old is not None:
        kept = old.filter(F.col("source").isNull() | ~F.col("source").isin(*replacing))
        df = df.unionByName(kept, allowMissingColumns=True).select(*df.columns)
    snapshots.commit(df.sort(*(F.col(k).asc_nulls_last() for k in key)), path, base)


def stored_sources(spark: SparkSession, root: str) -> DataFrame:
    return _stored(spark, root, OBSERVATION + ", year int").select("source").distinct()


def fingerprint(df: DataFrame, *by: str) -> DataFrame:
    """Rows and a 128-bit digest of a table, or of each of its partitions ``by``.

    The digest is that of the multiset of rows: the halves of every row's MD5 added up
    modulo 2^64, in hexadecimal. It knows no order, a repeated row changes it, and those of
    parts add up to that of the whole (:func:`merged_fingerprints`). A row's text joins its
    columns by ``|``: times as microseconds, doubles with nine decimals of an exponent
    form, nulls as ``~``; these marks are escaped where a text has them.
    """
    def text(name: str, kind: str):
        c = F.col(f"`{name}`")
        if kind.startswith("timestamp"):
            c = F.unix_micros(c.cast("timestamp")).cast("string")
        elif kind in ("double", "float"):
            c = F.format_string("%.9e", c)
        else:
            c = F.regexp_replace(c.cast("string"), r"([\\|~])", r"\\$1")
        return F.when(F.col(f"`{name}`").isNotNull(), c).otherwise("~")

    row = F.md5(F.concat_ws("|", *(text(*x) for x in df.dtypes)))
    halves = [F.conv(F.substring(row, i, 16), 16, 10).cast("decimal(28,0)").alias(n) for n, i in (("__hi", 1), ("__lo", 17))]
    return _digests(df.select(*by, F.lit(1).cast("long").alias("n_rows"), *halves), by)


def _digests(halves: DataFrame, by: tuple[str, ...]) -> DataFrame:
    whole = F.lit(str(2**64)).cast("decimal(38,0)")
    part = lambda c: F.lpad(F.lower(F.conv(F.pmod(F.sum(c).cast("decimal(38,0)"), whole).cast("string"), 10, 16)), 16, "0")
    return halves.groupBy(*by).agg(F.coalesce(F.sum("n_rows"), F.lit(0).cast("long")).alias("n_rows"), F.coalesce(F.concat(part("__hi"), part("__lo")), F.lit("0" * 32)).alias("digest"))


def merged_fingerprints(parts: DataFrame, *by: str) -> DataFrame:
    """The fingerprint of the whole, or of each group ``by``, from those of its parts."""
    halves = [F.conv(F.substring("digest", i, 16), 16, 10).cast("decimal(28,0)").alias(n) for n, i in (("__hi", 1), ("__lo", 17))]
    return _digests(parts.select(*by, "n_rows", *halves), by)


def changed_partitions(new: DataFrame, old: DataFrame, *by: str) -> DataFrame:
    """Keys of the partitions that differ between two builds: other rows, or in one of them only."""
    sides = [fingerprint(df, *by).select(F.struct(*by).alias("key"), F.concat_ws("/", F.col("n_rows").cast("string"), "digest").alias(n)) for df, n in ((new, "a"), (old, "b"))]
    return sides[0].join(sides[1], "key", "full").filter(~F.col("a").eqNullSafe(F.col("b"))).select("key.*")


def append_audit(df: DataFrame, root: str, table: str, run_id: str) -> None:
    """Append a run's records of files, series, tables, warnings or gaps."""
    if table not in ("run_files", "run_series", "run_tables", "run_warnings", "run_gaps"):
        raise ValueError(f"no audit table is called {table}")
    df.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(f"{root}/{table}")


def counts(rows: DataFrame) -> DataFrame:
    """Rows, missing values and flags by file and parameter."""
    return rows.groupBy("file", "parameter").agg(F.count("*").alias("n_rows"), F.count_if(F.col("value").isNull()).alias("n_missing"))
