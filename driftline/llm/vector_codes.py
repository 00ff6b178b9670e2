"""Vector code compression: every vector as one codebook index for each of its parts.

The codebooks come from exact integer k-means. Each task sorts a chunk of its vectors,
part by part, along a Hilbert curve and cuts the order into flat blocks that keep the
box (least and greatest components) and the sum of their points. In each round the
distances between box and entries leave a shortlist for each block: the entry whose
farthest point of the box is nearest is the anchor, and an entry stays if some point of
the box can lie as near to it as to the anchor. A block with one entry left adds its
stored sum; all others go through a small integer kernel of points by shortlist.

Chunks are stored once in the shared folder and read in every round; only
parts x entries sums leave a task, and only their totals reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import discard, stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Components become floor(SCALE * x).
SCALE = 1024
#: Points of a flat block.
BLOCK = 64
#: Components of a chunk at most, so that a chunk takes some 16 MB at any dimension.
CHUNK_VALUES = 1 << 22
#: Bits of each coordinate that a Hilbert key takes.
KEY_BITS = 4
#: Label totals up to this number meet the rows by broadcast; more are joined with salted keys.
BROADCAST_LABELS = 50_000
SALTS = 16


def usable(vector: Column) -> Column:
    """True for vectors that have components, all of them finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


@dataclass(frozen=True)
class Codebooks:
    """Final entries of every part, integers of shape (parts, entries, dimension / parts)."""

    entries: np.ndarray

    def sha256(self) -> str:
        """Hash of all components as decimal integers by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def decode(self, codes: DataFrame, code_col: str = "code") -> DataFrame:
        """``codes`` with the array ``decoded``: the components that each code stands for, over SCALE; null for a null code."""
        values = self.entries / SCALE

        @F.pandas_udf("array<double>")
        def decoded(code: pd.Series) -> pd.Series:
            return code.map(lambda c: None if c is None else np.concatenate([values[i, x] for i, x in enumerate(bytes.fromhex(c))]))

        return codes.withColumn("decoded", decoded(F.col(f"`{code_col}`")))


# --- chunks --------------------------------------------------------------------------------


def hilbert_order(points: np.ndarray, bits: int = KEY_BITS) -> np.ndarray:
    """Positions of ``points`` along the Hilbert curve through a grid of ``bits`` bits a coordinate."""
    n, k = points.shape
    low, high = int(points.min()), int(points.max())
    cells = ((points.astype(np.int64) - low) * (1 << bits) // (high - low + 1)).astype(np.uint32)
    key = np.packbits(hilbert_bits(cells, bits), axis=1)
    key = np.pad(key, ((0, 0), (0, -key.shape[1] % 8)))
    return np.lexsort(np.ascontiguousarray(key).view(">u8").reshape(n, -1).T[::-1])


def hilbert_bits(cells: np.ndarray, bits: int) -> np.ndarray:
    """Bits of the Hilbert index of each cell, most significant first (Skilling's transform, all cells at once)."""
    x = cells.T.copy()
    k = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for i in range(k):
            is_set = (x[i] & q) != 0
            swapped = np.where(is_set, 0, (x[0] ^ x[i]) & (q - 1)).astype(np.uint32)
            x[0] ^= np.where(is_set, q - 1, swapped).astype(np.uint32)
            x[i] ^= swapped
    for i in range(1, k):
        x[i] ^= x[i - 1]
    flips = np.zeros_like(x[0])
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        flips ^= np.where(x[-1] & q, q - 1, 0).astype(np.uint32)
    x ^= flips
    planes = [(x >> np.uint32(b)) & 1 for b in range(bits - 1, -1, -1)]
    return np.concatenate(planes).T.astype(np.uint8)


def integers(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of each component; a magnitude whose squared distances leave 62 bits is refused."""
    scaled = np.floor(values.astype(np.float64) * SCALE)
    most = float(np.abs(scaled).max(initial=0.0))
    if values.shape[1] * 4 * most * most >= 2.0**62 or most >= 2.0**31:
        raise ValueError(f"components up to {most / SCALE:g} are too large for exact squared distances")
    return scaled.astype(np.int32)


def _columns(batch: pa.RecordBatch) -> tuple[pa.Array, pa.Array, np.ndarray]:
    vectors = batch.column(2)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return batch.column(0), batch.column(1), flat.reshape(len(vectors), -1)


def _chunk(ids: list[pa.Array], labels: list[pa.Array], vectors: list[np.ndarray], kind: pa.Schema) -> pa.RecordBatch:
    points = integers(np.concatenate(vectors))
    n, d = points.shape
    starts = np.arange(0, n, BLOCK)
    order, out = [], {"points": [], "low": [], "high": [], "total": []}
    for part in np.split(points, PARTS, axis=1):
        at = hilbert_order(part)
        part = np.ascontiguousarray(part[at])
        order.append(at.astype(np.int32))
        out["points"].append(part)
        out["low"].append(np.minimum.reduceat(part, starts))
        out["high"].append(np.maximum.reduceat(part, starts))
        out["total"].append(np.add.reduceat(part.astype(np.int64), starts))

    def whole(arrays: list[pa.Array], at: int) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.concat_arrays(arrays)).cast(kind.field(at).type)

    packed = [pa.array([np.stack(a).tobytes()], pa.binary()) for a in (order, *out.values())]
    return pa.RecordBatch.from_arrays([whole(ids, 0), whole(labels, 1), pa.array([d], pa.int32()), *packed], schema=kind)


def _chunks(rows: DataFrame) -> DataFrame:
    """One row for each chunk: ids, labels, dimension, and the blocks of every part as bytes."""
    label = rows.schema["label"].dataType
    schema = T.StructType(
        [T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("labels", T.ArrayType(label)), T.StructField("dimension", T.IntegerType())]
        + [T.StructField(c, T.BinaryType()) for c in ("ordered", "points", "low", "high", "total")]
    )
    kind = pa.schema(
        [("ids", pa.list_(pa.int64())), ("labels", pa.list_(to_arrow_type(label))), ("dimension", pa.int32())]
        + [(c, pa.binary()) for c in ("ordered", "points", "low", "high", "total")]
    )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors, held = [], [], [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                i, label, v = _columns(batch.slice(start, 4096))
                ids.append(i)
                labels.append(label)
                vectors.append(v)
                held += v.size
                if held >= CHUNK_VALUES:
                    yield _chunk(ids, labels, vectors, kind)
                    ids, labels, vectors, held = [], [], [], 0
        if ids:
            yield _chunk(ids, labels, vectors, kind)

    return rows.select("vec_id", "label", "vector").mapInArrow(make, schema)


def _parts(batch: pa.RecordBatch, i: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """order, points, low, high and total of each part of chunk ``i``."""
    raw = {c: batch.column(c)[i].as_buffer() for c in ("ordered", "points", "low", "high", "total")}
    width = batch.column("dimension")[i].as_py() // PARTS
    order = np.frombuffer(raw["ordered"], np.int32).reshape(PARTS, -1)
    points, low, high = (np.frombuffer(raw[c], np.int32).reshape(PARTS, -1, width) for c in ("points", "low", "high"))
    total = np.frombuffer(raw["total"], np.int64).reshape(PARTS, -1, width)
    return zip(order, points, low, high, total, strict=True)


# --- rounds --------------------------------------------------------------------------------


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """blocks x entries, true where an entry can be the nearest one of a point of the block's box."""
    m, k = entries.shape
    norms = (entries * entries).sum(1)
    keep = np.empty((len(low), m), bool)
    step = max(1, (1 << 20) // (m * k))
    for at in range(0, len(low), step):
        lo, hi = low[at : at + step, None, :], high[at : at + step, None, :]
        reach = np.maximum(np.abs(entries - lo), np.abs(hi - entries))
        anchor = (reach * reach).sum(2).argmin(1)
        away = entries[None] - entries[anchor][:, None, :]
        # least of |p - entry|^2 - |p - anchor|^2 over the box, taken at a corner
        least = norms - norms[anchor][:, None] - 2 * np.maximum(away * lo, away * hi).sum(2)
        keep[at : at + step] = least <= 0
    return keep


def assign(
    points: np.ndarray, low: np.ndarray, high: np.ndarray, entries: np.ndarray, all_points: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry of every point (ties to the lower index), its squared distance, and each block's only entry or -1.

    Unless ``all_points``, points of blocks with an only entry are left at -1, as their sum is known.
    """
    most = max(int(np.abs(a).max(initial=0)) for a in (low, high, entries))
    # squared distances below 2**53 are exact in doubles, whose products run fast
    kind = np.float64 if points.shape[1] * 4 * most * most < 2**53 else np.int64
    low, high, entries = (a.astype(kind) for a in (low, high, entries))
    keep = shortlists(low, high, entries)
    norms = (entries * entries).sum(1)
    only = np.where(keep.sum(1) == 1, keep.argmax(1), -1)
    nearest = np.full(len(points), -1, np.int64)
    error = np.zeros(len(points), np.int64)
    for b in range(len(keep)):
        if only[b] >= 0 and not all_points:
            continue
        at = slice(b * BLOCK, (b + 1) * BLOCK)
        short = np.flatnonzero(keep[b])
        p = points[at].astype(kind)
        away = norms[short] - 2 * (p @ entries[short].T)
        best = away.argmin(1)
        nearest[at] = short[best]
        error[at] = away[np.arange(len(p)), best] + (p * p).sum(1)
    return nearest, error, only


def _new_sums(batches: Iterator[pa.RecordBatch], entries: np.ndarray) -> Iterator[pa.RecordBatch]:
    parts, m, k = entries.shape
    count, total = np.zeros((parts, m), np.int64), np.zeros((parts, m, k), np.int64)
    for batch in batches:
        for i in range(batch.num_rows):
            for part, (_, points, low, high, sums) in enumerate(_parts(batch, i)):
                nearest, _, only = assign(points, low, high, entries[part], False)
                size = np.minimum(BLOCK, len(points) - BLOCK * np.arange(len(only)))
                done = only >= 0
                np.add.at(count[part], only[done], size[done])
                np.add.at(total[part], only[done], sums[done])
                left = nearest >= 0
                count[part] += np.bincount(nearest[left], minlength=m)
                for j in range(k):  # a chunk's sums are exact in doubles
                    total[part, :, j] += np.bincount(nearest[left], points[left, j], m).astype(np.int64)
    part, entry = np.nonzero(count)
    columns = [pa.array(part), pa.array(entry), pa.array(count[part, entry])] + [pa.array(total[part, entry, j]) for j in range(k)]
    yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", *(f"s{j}" for j in range(k))])


def _refined(chunks: DataFrame, entries: np.ndarray) -> np.ndarray:
    """The entries after one round: floored means of their parts; unused entries stay."""
    k = entries.shape[2]
    names = ["n", *(f"s{j}" for j in range(k))]
    schema = ", ".join(f"{c} long" for c in ("part", "entry", *names))
    sums = chunks.select("dimension", "ordered", "points", "low", "high", "total").mapInArrow(lambda b: _new_sums(b, entries), schema)
    entries = entries.copy()
    for part, entry, n, *total in sums.groupBy("part", "entry").agg(*(F.sum(c).alias(c) for c in names)).collect():  # parts x entries rows
        entries[part, entry] = np.array(total, np.int64) // n
    return entries


def _coded(batches: Iterator[pa.RecordBatch], entries: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids, labels = batch.column("ids")[i].values, batch.column("labels")[i].values
            code, error = np.empty((len(ids), PARTS), np.uint8), np.zeros(len(ids), np.int64)
            for part, (order, points, low, high, _) in enumerate(_parts(batch, i)):
                nearest, distance, _ = assign(points, low, high, entries[part], True)
                code[order, part] = nearest
                error[order] += distance
            text = code.tobytes().hex()
            codes = [text[j : j + 2 * PARTS] for j in range(0, len(text), 2 * PARTS)]
            for at in range(0, len(ids), 8192):
                yield pa.RecordBatch.from_arrays(
                    [ids[at : at + 8192], labels[at : at + 8192], pa.array(codes[at : at + 8192]), pa.array(error[at : at + 8192])],
                    names=["vec_id", "label", "code", "error"],
                )


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", rounds: int = ROUNDS
) -> tuple[DataFrame, Codebooks | None]:
    """Codes of all usable vectors (vec_id, label, code, error, label_error) and the codebooks.

    The first entries are the parts of the ENTRIES smallest ids, ascending; null ids come
    last, rows of one id by their vectors, and with fewer rows the codebooks are smaller.
    ``error`` is the squared distance of the integer components to the code's entries,
    ``label_error`` its sum over all rows of the same label, null labels together.

    Vectors that are null, empty or hold a null or a component that is no finite number
    are left out. Rows that repeat count each; a null id is coded like any other. Other
    columns are never read. Without usable vectors there are no rows and no codebooks.
    Vectors of several lengths, a length that PARTS does not divide, and components too
    large for exact squared distances (131072 at 64 dimensions) raise ValueError.
    """
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), F.col(f"`{vector_col}`").alias("vector")
    ).filter(usable(F.col("vector")))
    least, most = rows.agg(F.min(F.size("vector")), F.max(F.size("vector"))).first()
    label_type = rows.schema["label"].dataType
    schema = T.StructType(
        [T.StructField("vec_id", T.LongType()), T.StructField("label", label_type), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    )
    if least is None:
        empty = vectors.sparkSession.createDataFrame([], schema)
        return empty.withColumn("label_error", F.lit(0).cast("long")), None
    if least != most or most % PARTS:
        raise ValueError(f"vectors of {least} to {most} components; one length is needed that {PARTS} divides")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(ENTRIES).select("vector").collect()  # ENTRIES rows
    entries = np.stack(np.split(integers(np.array([r.vector for r in first])), PARTS, axis=1)).astype(np.int64)
    chunks = stored(_chunks(rows), "chunks")
    for _ in range(rounds):
        entries = _refined(chunks, entries)
    last = entries
    codes = stored(chunks.mapInArrow(lambda b: _coded(b, last), schema), "codes")
    discard(chunks)
    return _with_label_error(codes), Codebooks(entries)


def _with_label_error(codes: DataFrame) -> DataFrame:
    totals = stored(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "totals")
    same = codes["label"].eqNullSafe(totals["label"])
    if totals.count() <= BROADCAST_LABELS:
        return codes.join(F.broadcast(totals), same).select(codes["*"], "label_error")
    codes = codes.withColumn("__salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)))
    totals = totals.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    same = codes["label"].eqNullSafe(totals["label"]) & (codes["__salt"] == totals["__part"])
    return codes.join(totals, same).select(codes["*"], "label_error").drop("__salt")


def code_table(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, code, error, label_error and the hash of the codebooks, as :func:`compress` makes them."""
    codes, books = compress(vectors, id_col, vector_col, label_col)
    digest = F.lit(books.sha256() if books else hashlib.sha256(b"").hexdigest())
    return codes.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))
