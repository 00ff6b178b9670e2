"""Benchmark decontamination: q-gram lemma over diagonal bands, then banded alignment."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from .common import discard, id_and_text, stored
from .textarrays import FOLD, batches

Q = 8
ERROR_RATIO = 0.06
#: Bytes of different folded items in one broadcast block; a larger benchmark is searched block by block.
BLOCK_BYTES = 4 << 20
#: Slices for each block in which the items are dealt by a hash; a block is made of whole slices.
SLICES = 16
#: Places of one q-gram in a block of items beyond which items do without it where they can.
COMMON = 64
_BATCH_BYTES = 1 << 20
#: Places of q-grams that a search lays out at once.
_LAID_OUT = 1 << 22
_BITS = 20
_SCATTER = np.uint64(0x9E3779B97F4A7C15)


def fold(text: str) -> bytes:
    """ASCII lower case, other ASCII but letters and digits as single spaces, no outer spaces."""
    return b" ".join(text.encode("utf-8", "surrogatepass").translate(FOLD).split())


def grams(data: bytes, q: int = Q) -> np.ndarray:
    """The q-gram at every position as a number; q is at most 8."""
    a = np.frombuffer(data, np.uint8)
    n = len(a) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    if q == 8:
        return np.ndarray((n,), "<u8", data, strides=(1,))
    out = np.zeros(n, np.uint64)
    for j in range(q):
        out |= a[j : j + n].astype(np.uint64) << np.uint64(8 * j)
    return out


@dataclass
class Index:
    """A block of different folded benchmark items, ready for the search."""

    items: list[bytes]
    budget: np.ndarray  # edits that are allowed
    least: np.ndarray  # shared q-grams that the lemma asks for
    gram: np.ndarray  # sorted distinct q-grams
    first: np.ndarray  # of each: where its places begin
    item_of: np.ndarray
    place: np.ndarray
    present: np.ndarray  # scattered q-grams, a filter without misses
    window: int  # length of the density window
    dense: int  # q-grams that some window of a match holds
    longest: int
    short: list[int]  # items too short for q-grams, found as whole words


def budget_of(length: int, ratio: float, q: int = Q) -> int:
    """floor(ratio * length), lowered until the lemma still asks for a shared q-gram."""
    return max(0, min(int(ratio * length), (length - q) // q))


def build_index(texts: list[bytes], ratio: float = ERROR_RATIO, q: int = Q) -> Index:
    """The index of ``texts``, which are folded, not empty and all different."""
    m = np.array([len(t) for t in texts], np.int64)
    k = np.array([budget_of(int(x), ratio, q) for x in m], np.int64)
    least = m - q + 1 - q * k
    per = [grams(t, q) for t in texts]
    every = np.concatenate([*per, np.empty(0, np.uint64)])
    item_of = np.repeat(np.arange(len(texts)), [len(p) for p in per]).astype(np.int64)
    place = np.concatenate([*(np.arange(len(p)) for p in per), np.empty(0, int)]).astype(np.int64)
    # an item does without its common q-grams, and asks for as many fewer, if it then asks for one at least
    _, same, times = np.unique(every, return_inverse=True, return_counts=True)
    common = times[same] > COMMON
    n_common = np.bincount(item_of[common], minlength=len(texts))
    least = np.where(least - n_common >= 1, least - n_common, least)
    left = ~(common & (least < m - q + 1 - q * k)[item_of])
    every, item_of, place = every[left], item_of[left], place[left]
    order = np.argsort(every, kind="stable")
    gram, first = np.unique(every[order], return_index=True)
    present = np.zeros(1 << _BITS, bool)
    present[(gram * _SCATTER) >> np.uint64(64 - _BITS)] = True
    long = m >= q
    window = int((m + k)[long].min()) if long.any() else 1
    span = -(-(m + k)[long] // window)
    return Index(
        texts, k, least, gram, np.append(first, len(every)), item_of[order], place[order], present, window,
        int(max(1, (-(-least[long] // span)).min())) if long.any() else 1,
        int((m + k).max()) if len(m) else 0,
        np.flatnonzero(~long).tolist(),
    )


def align(pattern: bytes, region: bytes, budget: int) -> tuple[int, int, int] | None:
    """Fewest edits between ``pattern`` and a part of ``region``: (edits, start, end), or None.

    The band is the region's diagonals; each row's insertions are resolved by a
    running minimum. Among equal results the earliest end wins.
    """
    n, m = len(region), len(pattern)
    text = np.frombuffer(region, np.uint8)
    steps = np.arange(n + 1)
    cost, origin = np.zeros(n + 1, np.int64), steps.copy()
    for c in pattern:
        straight = cost[:-1] + (text != c)
        best, source = cost + 1, origin.copy()
        better = straight < best[1:]
        best[1:][better] = straight[better]
        source[1:][better] = origin[:-1][better]
        lifted = best - steps
        low = np.minimum.accumulate(lifted)
        at = np.maximum.accumulate(np.where(lifted == low, steps, 0))
        cost, origin = low + steps, source[at]
        if cost.min() > budget:
            return None
    end = int(cost.argmin())
    return (int(cost[end]), int(origin[end]), end) if cost[end] <= budget and m else None


def search(ix: Index, texts: list[bytes], q: int = Q) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, edits, start, end) for the best place of every item that occurs in a text.

    The texts are searched together: positions whose q-gram is in the index are
    found by one pass, places too thin to hold a match go, the rest are counted by
    (text, item, band). Bands overlap by half, so all hits of a match, whose
    diagonals differ by its edits at most, meet in one band.
    """
    joined = (b"\x00" * q).join(texts) + b"\x00" * q
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + q)[:-1]))
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for i in ix.short:
        word = b" " + ix.items[i] + b" "
        for d, t in enumerate(texts):
            if ix.items[i] in t and (at := (b" " + t + b" ").find(word)) >= 0:
                best[d, i] = (0, at, at + len(ix.items[i]))
    if len(ix.gram):
        g = grams(joined, q)
        hit = ix.present[(g * _SCATTER) >> np.uint64(64 - _BITS)]
        total = np.concatenate(([0], np.cumsum(hit, dtype=np.int32)))
        w = min(ix.window, len(hit))
        full = np.flatnonzero(total[w:] - total[:-w] >= ix.dense)
        if len(full):
            near = np.zeros(len(hit) + 1, np.int32)
            np.add.at(near, np.maximum(full - ix.longest, 0), 1)
            np.add.at(near, np.minimum(full + w + ix.longest, len(hit)), -1)
            pos = np.flatnonzero(hit & (np.cumsum(near[:-1]) > 0))
            row = np.searchsorted(ix.gram, g[pos])
            row[row == len(ix.gram)] = 0
            real = ix.gram[row] == g[pos]
            pos, row = pos[real], row[real]
            bands = int((sizes.max(initial=0) + 2 * ix.longest) // (int(ix.budget.min()) + 1)) + 2
            codes, counts = _band_counts(ix, pos, row, starts, bands)
            # a band and the next together, which half-overlap with those about them
            following = np.searchsorted(codes, codes + 1)
            has = (following < len(codes)) & (codes[np.minimum(following, len(codes) - 1)] == codes + 1)
            pair = counts + np.where(has, counts[np.minimum(following, len(codes) - 1)], 0)
            pair_item = codes // bands % len(ix.items)
            for code_ in codes[pair >= ix.least[pair_item]].tolist():
                b, rest = code_ % bands, code_ // bands
                i, d = rest % len(ix.items), rest // len(ix.items)
                if best.get((d, i), (1,))[0] == 0:
                    continue
                k, wide = int(ix.budget[i]), int(ix.budget[i]) + 1
                lo = max(0, b * wide - ix.longest - k)
                hi = (b + 2) * wide - ix.longest + len(ix.items[i]) + k
                region = texts[d][lo:hi]
                exact = region.find(ix.items[i])
                found = (0, exact, exact + len(ix.items[i])) if exact >= 0 else align(ix.items[i], region, k)
                if found and (d, i) not in best or found and found[0] < best[d, i][0]:
                    best[d, i] = (found[0], found[1] + lo, found[2] + lo)
    for (d, i), (edits, a, b) in best.items():
        yield d, i, edits, a, b


def _band_counts(ix: Index, pos: np.ndarray, row: np.ndarray, starts: np.ndarray, bands: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of (text, item, band), sorted, and the shared q-grams of each, from positions and their rows in the index.

    A position stands for every place of its q-gram in the items; these are laid out a
    bounded number at a time and added up.
    """
    many = ix.first[row + 1] - ix.first[row]
    upto = np.cumsum(many)
    cuts = np.searchsorted(upto, np.arange(0, int(many.sum()) + _LAID_OUT, _LAID_OUT), side="right")
    codes, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if a == b:
            continue
        n = many[a:b]
        at = np.repeat(ix.first[row[a:b]] - (upto[a:b] - n - (upto[a] - n[0])), n) + np.arange(n.sum())
        item, shift = ix.item_of[at], ix.place[at]
        here = np.repeat(pos[a:b], n)
        doc = np.searchsorted(starts, here, side="right") - 1
        diagonal = here - starts[doc] - shift + ix.longest  # never negative
        more, times = np.unique((doc * len(ix.items) + item) * bands + diagonal // (ix.budget[item] + 1), return_counts=True)
        both = np.concatenate((codes, more))
        codes, inverse = np.unique(both, return_inverse=True)
        counts = np.bincount(inverse, np.concatenate((counts, times)), len(codes)).astype(np.int64)
    return codes, counts


class Block:
    """Some different items of the benchmark, folded; each worker builds its own index of them, once."""

    def __init__(self, items: list[bytes], ratio: float, q: int) -> None:
        self.items, self.ratio, self.q = items, ratio, q
        self._index: Index | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_index": None}

    @property
    def index(self) -> Index:
        if self._index is None:
            self._index = build_index(self.items, self.ratio, self.q)
        return self._index

    def found(self, texts: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item's place in the block, edits, start, end) of every match."""
        folded = [fold(t) for t in texts]
        for part in batches(folded, _BATCH_BYTES):
            for d, *rest in search(self.index, folded[part], self.q):
                yield part.start + d, *rest


@F.pandas_udf(BinaryType())
def _folded(texts: pd.Series) -> pd.Series:
    return texts.map(fold, na_action="ignore")


class Items:
    """The benchmark, read and folded once and kept in the shared folder.

    ``named`` has item_id and key (128 bits of the folded text) of every item, ``texts`` key,
    folded and slice of every different folded text. ``blocks`` gives runs of slices that hold
    about ``block_bytes`` each; a text longer than that is a block by itself at most with
    the others of its slice.
    """

    def __init__(self, benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> None:
        items = benchmark.select(F.col(f"`{id_col}`").cast("long").alias("item_id"), _folded(F.col(f"`{text_col}`").cast("string")).alias("folded"))
        items = items.filter("item_id is not null and length(folded) > 0").withColumn("key", F.md5("folded"))
        self.all = stored(items, "items")
        self.named = self.all.select("key", "item_id")
        texts = self.all.select("key", "folded").dropDuplicates(["key"])
        size = self.all.agg(F.sum(F.length("folded"))).first()[0] or 0
        slices = SLICES * -(-size // block_bytes) if size > block_bytes else 1
        texts = texts.withColumn("slice", F.pmod(F.xxhash64("key"), F.lit(slices)).cast("int"))
        if slices > 1:  # a block's read then skips the files of the other slices
            texts = stored(texts.repartitionByRange("slice").sortWithinPartitions("slice"), "item_texts")
        self.texts, self.slices, self.block_bytes = texts, slices, block_bytes

    def discard(self) -> None:
        """Delete what is kept, once no plan reads it."""
        discard(self.all, *([self.texts] if self.slices > 1 else []))

    def blocks(self) -> list[tuple[int, int]]:
        """First and last slice of each block; sums of bytes by slice come to the driver, SLICES for a block's bytes."""
        if self.slices == 1:
            return [(0, 0)]
        size = {r["slice"]: r["n"] for r in self.texts.groupBy("slice").agg(F.sum(F.length("folded")).alias("n")).collect()}
        out, held = [], 0
        for i in range(self.slices):
            n = size.get(i, 0)
            if not out or held + n > self.block_bytes and held:
                out, held = [*out, (i, i)], 0
            out[-1], held = (out[-1][0], i), held + n
        return out

    def broadcast(self, ratio: float, q: int) -> Iterator:
        """(broadcast block, its keys, whether it is the last); the driver holds the texts of one block at a time."""
        spark, blocks = self.all.sparkSession, self.blocks()
        for k, (a, b) in enumerate(blocks):
            rows = sorted((bytes(r["folded"]), r["key"]) for r in self.texts.filter(F.col("slice").between(a, b)).toLocalIterator())
            yield spark.sparkContext.broadcast(Block([t for t, _ in rows], ratio, q)), [key for _, key in rows], k == len(blocks) - 1


def _search_block(block, keys):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids = frame["doc_id"].tolist()
            rows = [(ids[d], keys.value[i], *rest) for d, i, *rest in block.value.found(frame["text"].tolist())]
            yield pd.DataFrame(rows, columns=["doc_id", "key", "edits", "start", "end"]).astype({"doc_id": "Int64"})

    return run


def _holds(block, text: Column) -> Column:
    """Whether a text holds an item of the block."""

    @F.pandas_udf("boolean")
    def run(texts: pd.Series) -> pd.Series:
        hit = np.zeros(len(texts), bool)
        hit[[d for d, *_ in block.value.found(texts.fillna("").tolist())]] = True
        return pd.Series(hit)

    return run(text)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    error_ratio: float = ERROR_RATIO,
    q: int = Q,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, item_id, edits, start, end: every benchmark item that occurs in a document.

    An item occurs if some part of the folded text is within
    ``floor(error_ratio * length)`` edits of the folded item (fewer where the q-gram
    lemma would ask for no shared q-gram). An item shorter than q occurs where its words
    stand as whole words. The row has the fewest edits and where that part lies in the folded text, in bytes.

    The benchmark is read once. Items that fold to one text are searched as one and named by a
    join at the end. The different texts are dealt by a hash and searched in blocks of about
    ``block_bytes``; a block's folded texts are broadcast, so what is broadcast is bounded
    whatever the benchmark's size and however often items repeat, and each worker builds
    the index. Every document meets every
    block, one pass for each. A q-gram that a block holds very often is left out
    for the items that can do without it, the others are laid out a bounded number at a time.
    Nulls: null or empty texts on either side match nothing, an item
    without an id is left out, a document without one is searched and reported with a
    null id. Items that repeat an id are each reported, rows that repeat are reported each. A
    long text is searched whole. Empty tables give no rows. Only the named columns are read.
    """
    base = id_and_text(docs, id_col, text_col)
    items = Items(benchmark, item_id_col, item_text_col, block_bytes)
    found = None
    for block, keys, last in items.broadcast(error_ratio, q):
        named = docs.sparkSession.sparkContext.broadcast(keys)
        one = base.mapInPandas(_search_block(block, named), "doc_id long, key string, edits long, start long, end long")
        if not last:
            one = stored(one, "leaks")
            block.unpersist()
            named.unpersist()
        found = one if found is None else found.unionByName(one)
    return found.join(items.named, "key").select("doc_id", "item_id", "edits", "start", "end")


def without_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    error_ratio: float = ERROR_RATIO,
    q: int = Q,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item occurs, with all their columns.

    Each row is judged by its own text whatever its id, so rows without an id and rows
    that repeat one are judged each. Null and empty texts stay. Empty tables: no rows,
    or all of them.
    """
    items = Items(benchmark, item_id_col, item_text_col, block_bytes)
    for block, _, last in items.broadcast(error_ratio, q):
        docs = docs.filter(~_holds(block, F.col(f"`{text_col}`")))
        if not last:
            docs = stored(docs, "clean")
            block.unpersist()
    items.discard()
    return docs
