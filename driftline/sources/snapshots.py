"""Tables that change by snapshot: new files first, then one manifest that names them.

A commit writes its rows to a folder of its own, ``commit=<id>``, and then a manifest under
``_snapshots`` that names, for every partition, the commit whose folder holds it. Readers
follow the newest manifest, so a run that ends between the steps leaves the old table
whole, and a table is never seen in part. Files are not changed once written; those that
no kept manifest names are deleted by :func:`expire`.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

FOLDER = "_snapshots"


@dataclass(frozen=True)
class Snapshot:
    """Number of the snapshot and, for each partition's folder ("" if unpartitioned), its commit."""

    number: int
    parts: dict[str, str]

    def folders(self, root: str) -> list[str]:
        return sorted(f"{root}/commit={commit}" + (f"/{part}" if part else "") for part, commit in self.parts.items())


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _manifests(spark: SparkSession, root: str) -> dict[int, str]:
    folder, fs = _files(spark, f"{root}/{FOLDER}")
    if not fs.exists(folder):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return {int(n[:-5]): f"{root}/{FOLDER}/{n}" for n in names if n.endswith(".json") and n[:-5].isdigit()}


def _load(spark: SparkSession, number: int, path: str) -> Snapshot:
    return Snapshot(number, json.loads(spark.read.text(path, wholetext=True).first()[0]))


def current(spark: SparkSession, root: str) -> Snapshot | None:
    """The newest snapshot; None if the table was never written."""
    found = _manifests(spark, root.rstrip("/"))
    return _load(spark, max(found), found[max(found)]) if found else None


def read(spark: SparkSession, root: str, schema: str | None = None, snapshot: Snapshot | None = None) -> DataFrame | None:
    """The rows that a snapshot (the newest unless given) names; None if there are none."""
    root = root.rstrip("/")
    snapshot = snapshot or current(spark, root)
    if snapshot is None or not snapshot.parts:
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    if list(snapshot.parts) == [""]:
        return reader.parquet(*snapshot.folders(root))
    return reader.option("basePath", root).parquet(*snapshot.folders(root)).drop("commit")


def _partitions(spark: SparkSession, path: str, depth: int) -> list[str]:
    place, fs = _files(spark, path + "/*" * depth)
    return ["/".join(s.getPath().toString().rsplit("/", depth)[1:]) for s in fs.globStatus(place) if s.isDirectory()]


def _publish(spark: SparkSession, root: str, snapshot: Snapshot) -> None:
    """Write the manifest aside and give it its name, which only one writer can do."""
    aside, fs = _files(spark, f"{root}/{FOLDER}/.{uuid.uuid4().hex}")
    name, _ = _files(spark, f"{root}/{FOLDER}/{snapshot.number:012d}.json")
    out = fs.create(aside, False)
    out.write(json.dumps(snapshot.parts, sort_keys=True).encode())
    out.close()
    if fs.exists(name) or not fs.rename(aside, name):
        fs.delete(aside, False)
        raise RuntimeError(f"another writer made snapshot {snapshot.number} of {root}; read it and write again")


def commit(df: DataFrame, root: str, base: Snapshot | None, partition_by: tuple[str, ...] = ()) -> Snapshot:
    """Write ``df`` and publish it on top of ``base``, the snapshot that its rows were made from.

    Partitions that ``df`` has replace those of ``base``; without partitions the whole table
    is replaced. If another writer published meanwhile, RuntimeError is raised and the
    table stays as that writer left it.
    """
    spark, root, name = df.sparkSession, root.rstrip("/"), uuid.uuid4().hex
    folder = f"{root}/commit={name}"
    df.write.partitionBy(*partition_by).parquet(folder)
    written = _partitions(spark, folder, len(partition_by)) if partition_by else [""]
    kept = base.parts if base and partition_by else {}
    snapshot = Snapshot(base.number + 1 if base else 1, kept | dict.fromkeys(written, name))
    _publish(spark, root, snapshot)
    return snapshot


def expire(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete all but the ``keep`` newest manifests and the folders of partitions that none of those names; how many.

    Not to be run beside a writer, whose files no manifest names yet.
    """
    root = root.rstrip("/")
    found = _manifests(spark, root)
    newest = sorted(found)[-keep:]
    named = {f for n in newest for f in _load(spark, n, found[n]).folders(root)}
    gone = 0
    for n in set(found) - set(newest):
        place, fs = _files(spark, found[n])
        fs.delete(place, False)
    depth = max((f.count("/") - root.count("/") for f in named), default=1)
    for part in _partitions(spark, root, depth):
        if part.startswith("commit=") and f"{root}/{part}" not in named:
            place, fs = _files(spark, f"{root}/{part}")
            gone += bool(fs.delete(place, True))
    return gone
