"""Session settings and shipping of this package to executors."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def session(app: str = "driftline", **conf: str) -> SparkSession:
    """A session with the settings the operators count on; a cluster's own settings come first."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names; only a local master may go without the setting."""
    place = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        place = tempfile.mkdtemp(prefix="driftline-")
    return f"{place.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, where several parts of a plan need the same rows.

    The files stay until whoever owns the folder clears it, as the plan reads them lazily.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _importable_by_workers() -> bool:
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    return any(p and os.path.abspath(p) == ROOT for p in paths)


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once, unless their PYTHONPATH has it already."""
    sc = spark.sparkContext
    if _importable_by_workers() or getattr(sc, "_driftline_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="driftline-"), "driftline.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(ROOT, "driftline")):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, ROOT))
    sc.addPyFile(path)
    sc._driftline_shipped = True


def shipped(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """``run`` after the executors have the package."""

    @functools.wraps(run)
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return run(spark, sf_dir)

    return call
