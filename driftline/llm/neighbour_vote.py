"""Quality by nearest-neighbour voting among labelled latent-semantic vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, is_held_out
from .convnet import training_rows
from .host_rules import measures

TERMS = 4096
DIMENSIONS = 48
NEIGHBOURS = 15
SHARPNESS = 8
#: Labelled documents of each class that are broadcast at most, a vector of DIMENSIONS floats each.
MAX_PER_CLASS = 1500
PREDICT_AT = 0.7
#: Documents of one block of the cosine product.
BLOCK = 256

#: Bounds of the bins of each whole-text measure; a document has one term of every measure.
BINS = {
    "symbols": (0.001, 0.02, 0.1, 0.3, 0.6, 1.5),
    "upper": (0.02, 0.05, 0.1, 0.3, 0.6),
    "repeated": (0.01, 0.05, 0.1, 0.2, 0.4, 0.7),
    "dup_lines": (0.01, 0.1, 0.25, 0.4, 0.6),
    "word_length": (3.0, 4.0, 4.5, 5.8, 6.5, 8.0),
    "words": (3, 10, 20, 50, 200, 1000),
}
META = sum(len(b) + 1 for b in BINS.values())
#: Weight of a bin beside the trigrams, whose row has length 1 before idf.
META_WEIGHT = 0.35


def terms(texts: list[str]) -> np.ndarray:
    """Unit rows: hashed character trigrams (logarithm of their counts), then binned measures."""
    out = np.zeros((len(texts), TERMS + META), np.float32)
    for i, t in enumerate(texts):
        a = np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
        if len(a) > 2:
            g = (a[:-2] * np.uint32(0x9E3779B1)) ^ (a[1:-1] * np.uint32(0x85EBCA77)) ^ (a[2:] * np.uint32(0xC2B2AE3D))
            g = (g ^ (g >> np.uint32(15))) * np.uint32(0x27D4EB2F)
            row = np.log1p(np.bincount(g >> np.uint32(32 - 12), minlength=TERMS)).astype(np.float32)
            out[i, :TERMS] = row / np.sqrt((row * row).sum())
        words, chars, symbols, dup, repeated = measures(t)
        upper = int(((a >= 65) & (a <= 90)).sum())
        per_word, per_char = 1 / max(1, words), 1 / max(1, chars)
        values = (symbols * per_word, upper * per_char, repeated * per_word, dup / (t.count("\n") + 1), chars * per_word, words)
        at = TERMS
        for v, bounds in zip(values, BINS.values(), strict=True):
            out[i, at + int(np.searchsorted(bounds, v, side="right"))] = META_WEIGHT
            at += len(bounds) + 1
    return out


@dataclass
class Voters:
    """Projection onto the latent space and the labelled vectors in it."""

    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    names: np.ndarray  # fingerprint of each voter's text
    prior: float
    class_weight: tuple[float, float]

    def latent(self, x: np.ndarray) -> np.ndarray:
        v = (x * self.idf) @ self.projection
        return v / np.maximum(np.sqrt((v * v).sum(1, keepdims=True)), 1e-12)

    def scores(self, texts: list[str]) -> np.ndarray:
        """Each text's vote; a voter of the same text has none, of voters at one cosine the earlier are nearer."""
        out = np.full(len(texts), self.prior)
        if not len(self.labels):
            return out
        for a in range(0, len(texts), BLOCK):
            part = texts[a : a + BLOCK]
            cosine = self.latent(terms(part)) @ self.vectors.T
            cosine[names(part)[:, None] == self.names] = -1
            near = nearest(cosine, min(NEIGHBOURS, cosine.shape[1]))
            weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** SHARPNESS
            label = self.labels[near]
            weight *= np.where(label == 1, self.class_weight[1], self.class_weight[0])
            total = weight.sum(1)
            ok = total > 1e-12
            out[a : a + BLOCK][ok] = ((weight * label).sum(1)[ok]) / total[ok]
        return np.clip(out, 0, 1)


def names(texts: list[str]) -> np.ndarray:
    """A 64-bit fingerprint of each text."""
    return np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) for t in texts], np.uint64)


def nearest(cosine: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest numbers of each row, in column order; equal ones fall to the first columns."""
    least = np.partition(cosine, -k, axis=1)[:, -k, None]
    above, level = cosine > least, cosine == least
    chosen = above | (level & (np.cumsum(level, 1) <= k - above.sum(1, keepdims=True)))
    return np.nonzero(chosen)[1].reshape(len(cosine), k)


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", per_class: int = MAX_PER_CLASS) -> Voters:
    """Project a bounded labelled sample by a truncated singular value decomposition.

    The decomposition is found by a seeded random range with power iterations. The
    sample is balanced where the table allows, and votes are weighted back to the
    shares of the whole label table.
    """
    rows = training_rows(docs, labels, target, per_class).toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    y = rows["y"].to_numpy(np.float64)
    share = (
        labels.filter(F.col(target).isin(0, 1) & ~is_held_out(F.col("doc_id")))
        .agg(F.avg(F.col(target).cast("double"))).first()[0]
    )
    share = 0.5 if share is None else share
    x = terms(rows["text"].tolist())
    df = (x > 0).sum(0)
    idf = (np.log((1 + len(x)) / (1 + df)) + 0.5).astype(np.float32)
    idf[TERMS:] = 1
    if not len(x):
        return Voters(idf, np.zeros((TERMS + META, 1), np.float32), np.zeros((0, 1), np.float32), y, names([]), share, (1, 1))
    weighted = x * idf
    rng = np.random.default_rng(11)
    d = min(DIMENSIONS, *weighted.shape)
    basis = np.linalg.qr(weighted.T @ rng.normal(size=(len(x), d + 8)).astype(np.float32))[0]
    for _ in range(4):
        basis = np.linalg.qr(weighted.T @ (weighted @ basis))[0]
    projection = basis @ np.linalg.svd(weighted @ basis, full_matrices=False)[2].T[:, :d]
    ys = y.mean()
    even = (share * (1 - ys) / max(ys * (1 - share), 1e-9)) if 0 < ys < 1 else 1.0
    made = Voters(idf, projection.astype(np.float32), np.zeros((0, 1), np.float32), y, names(rows["text"].tolist()), share, (1.0, float(even)))
    made.vectors = np.concatenate([made.latent(x[a : a + BLOCK]) for a in range(0, len(x), BLOCK)])
    return made


def vote(docs: DataFrame, labels: DataFrame, per_class: int = MAX_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted: similarity-weighted vote of the nearest labelled documents.

    The labelled vectors, 2 * ``per_class`` at most, are broadcast; every document
    meets all of them by exact blocked cosine products. Only the text enters a
    score. A voter with the very text of the document has no vote, so no labelled row
    meets its own label; of voters at one cosine those of smaller doc_id are nearer.
    A null text is an empty one; rows without an id and repeated rows are
    scored each. Without labels the score is 0.5. An empty table gives no rows. Of
    ``docs`` doc_id and text are read, so columns of other names never clash.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, "quality", per_class))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame(
                {"doc_id": frame["doc_id"].astype("Int64"), "score": model.value.scores(frame["text"].tolist())}
            )

    return id_and_text(docs).mapInPandas(run, "doc_id long, score double").select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"),
    )
