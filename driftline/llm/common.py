"""Helpers shared by the corpus operators: shared storage, column picking, fingerprints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a local master may go without the setting (tests); it then gets a
    temporary folder. A cluster without the setting is refused.
    """
    conf = spark.sparkContext.getConf()
    place = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        place = tempfile.mkdtemp(prefix="driftline-")
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


def stored(df: DataFrame, label: str, **options: object) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    ``options`` go to the Parquet writer. :func:`discard` deletes the table again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._stored_at = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`stored` made, once nothing reads them any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator needs, under fixed names; other columns never clash."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, equal to 2: rows never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
