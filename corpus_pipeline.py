"""Training-data pipeline over ``documents``: quality, lines, near copies, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every
result to the shared folder and reads it back as the next stage's ``docs``. All
stages but the last return the columns of ``docs``.

A stage judges rows, not ids: rows without a doc_id and rows that repeat one are
judged each by their own text (line dedup alone lets rows without an id pass).
Null texts go with the quality rules. Of rows that tie as copies the one of the
smallest doc_id stays, of equal ids one. An empty table gives no rows. Columns
whose names begin with two underscores are not allowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import circulant_minhash, host_rules, line_dedup, packing, qgram_filter
from driftline.llm.common import discard, stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the rules or their host's record reject."""
    return host_rules.without_rejected(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take later matching lines out of the texts; a document left without tokens goes."""
    return line_dedup.without_repeated_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near copies (shingles of five words), that of the smallest doc_id."""
    place = F.monotonically_increasing_id()
    rows = stored(docs.withColumn("__row", place), "rows")
    found = circulant_minhash.near_duplicates(rows, id_col="__row", width=5)
    # groups of more than one row; nothing is to be decided in the others
    linked = found.filter("doc_id <> component_id").select("component_id").distinct()
    many = found.join(linked, "component_id", "left_semi").select(F.col("doc_id").alias("__row"), "component_id")
    ids = rows.select("__row", "doc_id").join(many, "__row")
    first = ids.groupBy("component_id").agg(F.min_by("__row", F.struct(F.col("doc_id").isNull(), "doc_id", "__row")).alias("__row"))
    gone = ids.join(first, ["component_id", "__row"], "left_anti").select("__row")
    return rows.join(gone, "__row", "left_anti").drop("__row")


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return qgram_filter.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all that is left into sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", repeated_lines),
    ("minhash", near_copies),
    ("decontamination", benchmark_leaks),
    ("packing", packed),
]

#: Token ids, and so the last stage, are out of SQL's reach; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, last = stored(stage(spark, docs, sf_dir), name), before
        before = docs
        if last is not None:
            discard(last)
    return docs
