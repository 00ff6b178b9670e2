"""What a build leaves out or bends, counted in the build's own pass.

A :class:`Watch` hangs counters on frames on their way (``DataFrame.observe``); they are filled
by the write that reads them, so no second scan is needed. After the write, the counts come out as
warnings, rows for the audit table ``run_warnings``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from driftline.session import written


class Watch:
    """Counters of one run, by stage and warning."""

    def __init__(self) -> None:
        self._watched: list[tuple[str, Observation]] = []

    def count(self, df: DataFrame, stage: str, **conditions: Column) -> DataFrame:
        """``df``, whose rows that meet each condition are counted when it is written."""
        seen = Observation(f"{stage}-{uuid.uuid4().hex}")
        self._watched.append((stage, seen))
        return df.observe(seen, *(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()))

    def warnings(self, spark: SparkSession) -> DataFrame:
        """stage, warning, n_rows of all that was counted at least once; only after every watched frame was written."""
        rows = [(stage, name, n) for stage, seen in self._watched for name, n in seen.get.items() if n]
        return spark.createDataFrame(rows, "stage string, warning string, n_rows long")


def counted(watch: Watch | None, df: DataFrame, stage: str, **conditions: Column) -> DataFrame:
    """``df`` under ``watch``, if there is one; for frames that are read once, as by a write without a sort."""
    return df if watch is None else watch.count(df, stage, **conditions)


def counted_once(watch: Watch | None, df: DataFrame, stage: str, **conditions: Column) -> DataFrame:
    """``df`` under ``watch``, if there is one, and then written, as a reader that samples or joins would count it again."""
    return df if watch is None else written(watch.count(df, stage, **conditions), stage)
