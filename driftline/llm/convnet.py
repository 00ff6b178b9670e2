"""Toxicity by a convolutional text classifier, trained in numpy on shards of all labelled rows, with thresholds by language."""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, is_held_out, stored
from .textarrays import FOLD, batches, word_pieces

PREFIXES = (4, 6)
WIDTHS = (1, 2, 3)
FILTERS = 12
DIM = 12
#: Labelled documents of each class that training reads at most: all.
MAX_PER_CLASS = None
PREDICT_AT = 0.3
#: Buckets of the hashed vocabulary, so that a net takes 13 MB at most.
BUCKETS = 1 << 18
#: Training documents that must hold a piece before it has an embedding.
MIN_DOCS = 4
#: Validation rows of a language that its own threshold needs.
MIN_ROWS = 40
_BATCH_BYTES = 1 << 19
#: Labelled documents of one shard, of one step, and that training sees over all passes if the table is small.
SHARD_ROWS = 8192
STEP_ROWS = 32
LEARNED_ROWS = 48_000
#: Labels that are broadcast to the texts at most.
BROADCAST_ROWS = 2_000_000
#: Rows of the embedding whose sums are made together, and steps of a logit.
SLICE_ROWS = 1024
Z_STEPS = 64


def fold(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").translate(FOLD)


def pieces(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word and its prefixes (-1: none), and each text's first word."""
    h, offsets = word_pieces(texts, PREFIXES)
    bucket = (h >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
    bucket[h == 0] = -1
    return bucket, offsets


@dataclass
class ConvNet:
    """Hashed embeddings, filters of several widths, maxima over the text, one logistic unit."""

    row_of: np.ndarray  # bucket -> row of the embedding; row 0 is zero
    embedding: np.ndarray
    kernels: list[np.ndarray]  # width x dim x filters
    biases: list[np.ndarray]
    out: np.ndarray
    bias: float = 0.0
    scale: tuple[float, float] = (1.0, 0.0)  # of the logit, after calibration
    thresholds: dict[str, float] = field(default_factory=dict)

    def rows(self, bucket: np.ndarray) -> np.ndarray:
        rows = self.row_of[bucket]
        rows[bucket < 0] = 0
        return rows

    def maps(self, rows: np.ndarray, cuts: np.ndarray) -> list[np.ndarray]:
        """Filter responses at each place; texts are set apart by zero words."""
        x = self.embedding[rows].sum(1)
        wide = max(WIDTHS) - 1
        padded = np.zeros((len(x) + wide * len(cuts) + wide, x.shape[1]), np.float32)
        lengths = np.diff(np.append(cuts, len(x)))
        at = np.arange(len(x)) + wide * np.repeat(np.arange(len(cuts)), lengths)
        padded[at] = x
        n = len(padded) - wide
        return [sum(padded[j : j + n] @ k[j] for j in range(len(k))) + b for k, b in zip(self.kernels, self.biases, strict=True)]

    def logits(self, bucket: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Uncalibrated logits; a text without words has one zero word."""
        lengths = np.diff(offsets)
        wide = max(WIDTHS) - 1
        if not len(lengths):
            return np.zeros(0)
        cuts = offsets[:-1]
        starts = cuts + wide * np.arange(len(cuts))
        maps = self.maps(self.rows(bucket), cuts)
        # every second run lies between two texts
        runs = np.column_stack([starts, starts + np.maximum(lengths, 1)]).ravel()
        pooled = [np.maximum(np.maximum.reduceat(m, runs, axis=0)[::2], 0) for m in maps]
        return np.concatenate(pooled, 1) @ self.out + self.bias

    def scores(self, texts: list[bytes]) -> np.ndarray:
        a, b = self.scale
        z = np.clip(a * self.logits(*pieces(texts)) + b, -30, 30)
        return 1 / (1 + np.exp(-z))


class Trainer:
    """Adam on the weighted log loss for one net; of the embedding only the rows that a step touches move."""

    def __init__(self, net: ConvNet, rate: float = 0.01) -> None:
        self.net, self.rate, self.step = net, rate, 0
        self.dense = [*net.kernels, *net.biases, net.out]
        self.first, self.second = [np.zeros_like(p) for p in self.dense], [np.zeros_like(p) for p in self.dense]
        self.rows_first, self.rows_second = np.zeros_like(net.embedding), np.zeros_like(net.embedding)
        #: Texts that moved each row of the embedding.
        self.touched = np.zeros(len(net.embedding), np.float32)

    def _moved(self, p: np.ndarray, d: np.ndarray, m: np.ndarray, v: np.ndarray) -> None:
        m += 0.1 * (d - m)
        v += 0.001 * (d * d - v)
        p -= self.rate * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)

    def learn(self, codes: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> None:
        """One step on a few texts, each given by the buckets of its words."""
        net, wide = self.net, max(WIDTHS) - 1
        lengths = np.array([len(c) for c in codes])
        cuts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        rows = net.rows(np.concatenate(codes))
        maps = net.maps(rows, cuts)
        starts = cuts + wide * np.arange(len(cuts))
        arg = [np.stack([m[s : s + n].argmax(0) + s for s, n in zip(starts, lengths, strict=True)]) for m in maps]
        top = np.concatenate([np.take_along_axis(m, a, 0) for m, a in zip(maps, arg, strict=True)], 1)
        pooled = np.maximum(top, 0)
        z = pooled @ net.out + net.bias
        g = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(codes)
        dtop = (g[:, None] * net.out * (top > 0)).astype(np.float32)
        places, moves, dk, db = [], [], [], []
        for q, (k, a) in enumerate(zip(net.kernels, arg, strict=True)):
            d = dtop[:, q * FILTERS : (q + 1) * FILTERS]
            grad = np.zeros_like(k)
            for j in range(len(k)):
                at = a - wide * np.arange(len(codes))[:, None] + j
                inside = at < (cuts + lengths)[:, None]
                at = np.where(inside, at, 0)
                dj = np.where(inside, d, 0)
                grad[j] = np.einsum("bf,bfd->df", dj, net.embedding[rows[at]].sum(2))
                places.append(at.ravel())
                moves.append((dj[..., None] * k[j].T[None]).reshape(-1, net.embedding.shape[1]))
            dk.append(grad)
            db.append(d.sum(0))
        place, move = np.concatenate(places), np.concatenate(moves)
        some = np.abs(move).sum(1) > 0
        place, move = place[some], move[some]
        hit = rows[place].ravel()
        touched, where = np.unique(hit, return_inverse=True)
        de = np.zeros((len(touched), net.embedding.shape[1]), np.float32)
        np.add.at(de, where.ravel(), np.repeat(move, rows.shape[1], 0))
        self.step += 1
        e, m, v = net.embedding[touched], self.rows_first[touched], self.rows_second[touched]
        self._moved(e, de + 1e-5 * e, m, v)
        net.embedding[touched], self.rows_first[touched], self.rows_second[touched] = e, m, v
        net.embedding[0] = 0
        self.touched[touched] += len(codes)
        for p, d, m, v in zip(self.dense, [*dk, *db, (pooled.T @ g).astype(np.float32)], self.first, self.second, strict=True):
            self._moved(p, d, m, v)
        net.bias -= self.rate * float(g.sum())


def untrained(known: np.ndarray, seed: int = 3) -> ConvNet:
    """A net with an embedding for each known bucket."""
    rng = np.random.default_rng(seed)
    row_of = np.zeros(BUCKETS, np.int32)
    row_of[known] = np.arange(1, len(known) + 1)
    normal = lambda *s: rng.normal(0, 1, s).astype(np.float32)
    net = ConvNet(
        row_of, 0.1 * normal(len(known) + 1, DIM), [0.5 * normal(w, DIM, FILTERS) / np.sqrt(w) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS], 0.3 * normal(len(WIDTHS) * FILTERS),
    )
    net.embedding[0] = 0
    return net


def coded(texts: list[str]) -> list[np.ndarray]:
    """The buckets of each text's words; a text without words has one that is no bucket."""
    bucket, offsets = pieces([fold(t) for t in texts])
    none = np.full((1, 1 + len(PREFIXES)), -1, np.int64)
    return [bucket[a:b] if b > a else none for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _class_weights(n: tuple[float, float]) -> np.ndarray:
    """Weights under which both classes count alike, from the rows of each."""
    return np.array([sum(n) / (2 * max(1.0, x)) for x in n])


def train(
    texts: list[str], labels: list[int], seed: int = 3, epochs: int = 8, rate: float = 0.01
) -> tuple[ConvNet, np.ndarray]:
    """Fit on texts at hand, one fifth set aside to calibrate the logit; also tells which rows those are."""
    rng = np.random.default_rng(seed)
    y = np.asarray(labels, np.float64)
    codes = coded(texts)
    aside = rng.random(len(y)) < 0.2
    fitted = np.flatnonzero(~aside)
    each = [np.unique(codes[i][codes[i] >= 0]) for i in fitted]
    found, df = np.unique(np.concatenate([*each, np.empty(0, np.int64)]), return_counts=True)
    net = untrained(found[df >= MIN_DOCS], seed)
    trainer = Trainer(net, rate)
    weight = _class_weights(((y[fitted] == 0).sum(), (y[fitted] == 1).sum()))[y.astype(int)]
    for _ in range(epochs if len(fitted) else 0):
        for part in np.array_split(rng.permutation(fitted), max(1, len(fitted) // STEP_ROWS)):
            trainer.learn([codes[i] for i in part], y[part], weight[part])
    held = np.flatnonzero(aside)
    if len(held) and 0 < y[held].sum() < len(held):
        z = np.array([float(net.logits(codes[i], np.array([0, len(codes[i])]))[0]) for i in held])
        net.scale = _platt(z, y[held], np.ones(len(held)))
    return net, aside


def _platt(z: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Scale and shift of the logit by penalised logistic regression; ``n`` rows have each (z, y).

    By Newton's method, whose steps are halved until the loss falls, so that classes far apart cannot throw it off.
    """
    def loss(a: float, b: float) -> float:
        t = a * z + b
        return float((n * (np.logaddexp(0, t) - y * t)).sum() + 0.05 * (a - 1) ** 2)

    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = n * (p * (1 - p) + 1e-6)
        grad = np.array([(n * (p - y) * z).sum() + 0.1 * (a - 1), (n * (p - y)).sum()])
        hess = np.array([[(w * z * z).sum() + 0.1, (w * z).sum()], [(w * z).sum(), w.sum()]])
        move = np.linalg.solve(hess + 1e-9 * np.eye(2), grad)
        at = loss(a, b)
        while loss(a - move[0], b - move[1]) > at and np.abs(move).max() >= 1e-8:
            move = move / 2
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-8:
            break
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def training_rows(docs: DataFrame, labels: DataFrame, target: str, per_class: int | None, with_lang: bool = False) -> DataFrame:
    """Texts and labels to learn from: all, or ``per_class`` of each class at most, in an order fixed by a hash.

    Rows with a missing id, a label other than 0 or 1, or an id held out are never used.
    Of rows that repeat an id one is taken, that of the least text, before anything is
    gathered; of labels that repeat an id the least.
    """
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("y"))
        .filter(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("y").alias("y"))
    )
    if per_class is None:
        # up to so many short rows are sent to the texts; beyond that both are shuffled
        chosen = F.broadcast(usable) if usable.count() <= BROADCAST_ROWS else usable
    else:
        order = F.xxhash64("doc_id")
        chosen = F.broadcast(usable.filter("y = 1").orderBy(order, "doc_id").limit(per_class).unionByName(
            usable.filter("y = 0").orderBy(order, "doc_id").limit(per_class)
        ))
    extra = ["lang"] if with_lang else []
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *extra)
    picked = picked.join(chosen, "doc_id")
    return picked.groupBy("doc_id").agg(F.min(F.struct("text", "y", *extra)).alias("r")).select("doc_id", "r.*")


def _slices(texts: pd.Series) -> Iterator[tuple[slice, list[np.ndarray]]]:
    """The texts coded, about _BATCH_BYTES at once."""
    whole = texts.tolist()
    for part in batches([fold(t) for t in whole], _BATCH_BYTES):
        yield part, coded(whole[part])


def _known(rows: DataFrame) -> np.ndarray:
    """Buckets that at least MIN_DOCS of the rows hold."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df = np.zeros(BUCKETS, np.int64)
        for frame in frames:
            for _, codes in _slices(frame["text"]):
                for c in codes:
                    df[np.unique(c[c >= 0])] += 1
        found = np.flatnonzero(df)
        yield pd.DataFrame({"bucket": found, "n": df[found]})

    counts = rows.select("text").mapInPandas(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    return np.sort(counts.filter(F.col("n") >= MIN_DOCS).select("bucket").toPandas()["bucket"].to_numpy(np.int64))


def _learned(rows: DataFrame, net: ConvNet, weights: np.ndarray, rate: float) -> ConvNet:
    """The net after one pass over all rows: every shard learns from the same net, and what they learned is averaged.

    A row of the embedding is moved by the mean of the shards' moves, each by the texts that
    moved it there; the other parameters are averaged by the shards' rows. Sums are made by slices of
    the parameters on the executors, in the order of the shards.
    """
    sent = rows.sparkSession.sparkContext.broadcast(net)

    def sums(shard: int, trainer: Trainer, n: int) -> pd.DataFrame:
        now, before, count = trainer.net, sent.value.embedding, trainer.touched
        flat = np.concatenate([*(p.ravel() for p in trainer.dense), [now.bias, 1.0]]).astype(np.float64) * n
        found = [(-1, flat.tobytes())]
        for a in range(0, len(count), SLICE_ROWS):
            c = count[a : a + SLICE_ROWS].astype(np.float64)
            if c.any():
                move = c[:, None] * (now.embedding[a : a + SLICE_ROWS] - before[a : a + SLICE_ROWS])
                found.append((a, np.column_stack([c, move]).tobytes()))
        return pd.DataFrame(found, columns=["slice", "sums"]).assign(shard=shard)[["shard", "slice", "sums"]]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, trainer, n = None, None, 0
        for frame in frames:
            for name, own in frame.groupby("shard", sort=False):
                if name != shard:
                    if trainer:
                        yield sums(shard, trainer, n)
                    shard, trainer, n = name, Trainer(copy.deepcopy(sent.value), rate), 0
                y = own["y"].to_numpy()
                for part, codes in _slices(own["text"]):
                    labels = y[part]
                    for a in range(0, len(codes), STEP_ROWS):
                        at = slice(a, a + STEP_ROWS)
                        trainer.learn(codes[at], labels[at], weights[labels[at]])
                n += len(own)
        if trainer:
            yield sums(shard, trainer, n)

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("shard", kind="stable")
        total = sum(np.frombuffer(x) for x in frame["sums"])
        return pd.DataFrame({"slice": frame["slice"].iloc[:1], "sums": [total.tobytes()]})

    learned = rows.select("shard", "y", "text").mapInPandas(run, "shard int, slice int, sums binary")
    net = copy.deepcopy(net)
    for row in learned.groupBy("slice").applyInPandas(added, "slice int, sums binary").toLocalIterator():
        total = np.frombuffer(row["sums"])
        if row["slice"] < 0:
            flat, at = total[:-1] / total[-1], 0
            for p in (*net.kernels, *net.biases, net.out):
                p[...] = flat[at : at + p.size].reshape(p.shape)
                at += p.size
            net.bias = float(flat[at])
        else:
            total = total.reshape(-1, 1 + DIM)
            net.embedding[row["slice"] : row["slice"] + len(total)] += total[:, 1:] / np.maximum(total[:, :1], 1)
    sent.destroy()
    return net


def _judged(rows: DataFrame, net: ConvNet) -> pd.DataFrame:
    """lang, y, z and how many rows have them; logits in steps of 1 / Z_STEPS."""
    sent = rows.sparkSession.sparkContext.broadcast(net)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            z = np.zeros(len(frame))
            for part, codes in _slices(frame["text"]):
                offsets = np.concatenate(([0], np.cumsum([len(c) for c in codes])))
                z[part] = sent.value.logits(np.concatenate(codes), offsets)
            yield pd.DataFrame({"lang": frame["lang"], "y": frame["y"], "z": np.rint(np.clip(z, -30, 30) * Z_STEPS).astype(int)})

    found = rows.select("lang", "y", "text").mapInPandas(run, "lang string, y int, z int").groupBy("lang", "y", "z").agg(F.count("*").alias("n"))
    return found.toPandas().sort_values(["lang", "y", "z"], kind="stable")


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", per_class: int | None = MAX_PER_CLASS) -> ConvNet:
    """Learn from all labelled rows and set a threshold for each language.

    The rows are stored once, dealt to shards of about SHARD_ROWS by a hash of their ids, a
    fifth of them aside. Words that MIN_DOCS of the others hold have an embedding. In each pass every shard
    learns from the same net, and the learned nets are averaged (:func:`_learned`); a table
    is passed 8 times if it is small and twice if it is large. The classes count alike in the loss; the logit is then
    calibrated, and thresholds are set, on all rows aside. A language with at least MIN_ROWS of these, of both
    classes, gets the threshold with the best F1 on them, another the threshold of all of them.
    """
    rows = training_rows(docs, labels, target, per_class, with_lang=True)
    place = F.xxhash64(F.lit(3), "doc_id")
    rows = stored(rows.withColumn("aside", F.pmod(place, F.lit(5)) == 0).withColumn("place", place), "labelled")
    by_class = {(r["aside"], r["y"]): r["n"] for r in rows.groupBy("aside", "y").agg(F.count("*").alias("n")).collect()}
    n = tuple(by_class.get((False, y), 0) for y in (0, 1))
    shards = max(1, round(sum(n) / SHARD_ROWS))
    # a file holds whole shards in a fixed order, so every pass reads them as they are
    dealt = rows.filter("not aside").withColumn("shard", F.pmod(F.xxhash64(F.lit(4), "doc_id"), F.lit(shards)).cast("int"))
    dealt = stored(dealt.repartition(shards, "shard").sortWithinPartitions("shard", "place", "doc_id").select("shard", "y", "text"), "shards")
    net = untrained(_known(dealt))
    passes = min(8, max(2, round(LEARNED_ROWS / max(1, sum(n))))) if sum(n) else 0
    for i in range(passes):
        net = _learned(dealt, net, _class_weights(n), 0.01 * (1 - i / passes))
    found = _judged(rows.filter("aside"), net)
    discard(rows, dealt)
    z, y, count = found["z"].to_numpy(np.float64) / Z_STEPS, found["y"].to_numpy(np.float64), found["n"].to_numpy()
    if by_class.get((True, 0)) and by_class.get((True, 1)):
        net.scale = _platt(z, y, count)
    score = 1 / (1 + np.exp(-np.clip(net.scale[0] * z + net.scale[1], -30, 30)))
    net.thresholds = _thresholds(score, y, found["lang"].to_numpy(), (1.0, 1.0), count)
    return net


def _thresholds(
    score: np.ndarray, y: np.ndarray, lang: np.ndarray, weights: tuple[float, float], n: np.ndarray | None = None
) -> dict[str, float]:
    """The threshold of all rows (key "") and of each language that has enough of them; none without both classes.

    ``n`` rows have each score, label and language, one unless given.
    """
    n = np.ones(len(y), np.int64) if n is None else n
    both = lambda part: 0 < y[part].sum() < part.sum()
    groups = {"": np.ones(len(y), bool)} | {x: lang == x for x in set(lang) if isinstance(x, str)}
    return {
        x: _best_threshold(score[part], y[part], weights, n[part])
        for x, part in groups.items() if both(part) and (x == "" or n[part].sum() >= MIN_ROWS)
    }


def _best_threshold(score: np.ndarray, y: np.ndarray, weights: tuple[float, float], n: np.ndarray | int = 1) -> float:
    """The threshold of best F1 under the weights of classes 0 and 1; among equals the middle one."""
    grid = np.arange(1, 100) / 100
    above = score[None] >= grid[:, None]
    right, wrong = weights[1] * (above & (y == 1)) @ (n * np.ones(len(y))), weights[0] * (above & (y == 0)) @ (n * np.ones(len(y)))
    f1 = 2 * right / (right + wrong + weights[1] * (n * (y == 1)).sum())
    best = np.flatnonzero(f1 == f1.max())
    return float(grid[best[len(best) // 2]])


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int | None = MAX_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted, and flagged by the threshold of the document's language.

    Every whole text is scored, and only the text enters the score; the language only
    picks the threshold of flagged. A null text counts as empty and gets the score
    of a text without words; rows without an id and repeated rows are scored each. A
    language that is null or has no threshold of its own takes that of all rows,
    without labels PREDICT_AT. An empty table gives no rows. Of ``docs`` doc_id, text and
    lang are read, so columns of other names never clash.
    """
    net = fit(docs, labels, "toxic", per_class)
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.coalesce("text", F.lit("")).alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(net)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [fold(t) for t in frame["text"]]
            score = np.zeros(len(texts))
            for part in batches(texts, _BATCH_BYTES):
                score[part] = model.value.scores([t if t.strip() else b"\xff" for t in texts[part]])
            at = model.value.thresholds
            limit = frame["lang"].map(lambda x: at.get(x, at.get("", PREDICT_AT))).astype(float)
            yield pd.DataFrame(
                {"doc_id": frame["doc_id"].astype("Int64"), "score": score, "lang_threshold": limit.to_numpy()}
            )

    scored = marked.mapInPandas(run, "doc_id long, score double, lang_threshold double")
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"),
        "lang_threshold", (F.col("score") >= F.col("lang_threshold")).cast("int").alias("flagged"),
    )
