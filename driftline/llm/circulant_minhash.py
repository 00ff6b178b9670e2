"""Near-duplicate documents by circulant MinHash, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, id_and_text, stored
from .components import components
from .textarrays import batches, mix, shingle_sets

WIDTH = 4
PERCENT = 80
BANDS, ROWS = 40, 6
#: Rounds of linear pivot comparisons, at most, before what is left of a bucket is compared in full.
PIVOT_ROUNDS = 4
#: A round of which less than this share of the pairs is confirmed is the last.
WORTH = 0.1

# The odd constants of the permutation that is shifted, a bijection of 32-bit positions.
_PI_1, _PI_2 = np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)
#: 64-bit words of the parity map that bounds how far two sets differ.
PARITY_WORDS = 8
_BATCH_BYTES = 1 << 20
_BLOCK = 1 << 15


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """Circulant MinHash: row i holds ``coordinates`` minima of set i.

    The first permutation places each fingerprint on a circle of 2**32 positions;
    coordinate k is the minimum of the second permutation after shifting every
    position by k. Both permutations are bijections made of odd multiplications and
    xor-shifts, so no table of the circle is needed. Sets must not be empty.
    """
    out = np.full((len(sets), coordinates), 0xFFFFFFFF, np.uint32)
    if not sets:
        return out
    place = np.concatenate([(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32)).astype(np.uint32) for s in sets])
    ends = np.cumsum([len(s) for s in sets])
    turned = place * _PI_1
    scratch, shifted = np.empty(_BLOCK, np.uint32), np.empty(_BLOCK, np.uint32)
    for a in range(0, len(turned), _BLOCK):
        b = min(a + _BLOCK, len(turned))
        block, x, y = turned[a:b], shifted[: b - a], scratch[: b - a]
        lo = np.searchsorted(ends, a, side="right")
        hi = np.searchsorted(ends, b - 1, side="right") + 1
        cuts = np.concatenate(([0], ends[lo : hi - 1] - a)).astype(np.intp)
        for k in range(coordinates):
            np.add(block, np.uint32(k * int(_PI_1) & 0xFFFFFFFF), out=x)
            np.right_shift(x, 15, out=y)
            np.bitwise_xor(x, y, out=x)
            np.multiply(x, _PI_2, out=x)
            low = np.minimum.reduceat(x, cuts)
            np.minimum(out[lo:hi, k], low, out=out[lo:hi, k])
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each signature; the band's number is part of it."""
    keys = np.empty((len(signature), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(signature), b + 1, np.uint64)
        for r in range(rows):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + signature[:, b * rows + r])
        keys[:, b] = h
    return keys


def parity_map(shingles: np.ndarray) -> np.ndarray:
    """PARITY_WORDS numbers; each shingle flips one bit, so two maps differ in no more bits than the sets in members."""
    place = (shingles >> np.uint64(20)) % np.uint64(64 * PARITY_WORDS)
    odd = np.bincount(place.astype(np.int64), minlength=64 * PARITY_WORDS).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view("<i8")


def _lower_bytes(texts: pd.Series) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass").lower() for t in texts]


def _sign(width: int, bands: int, rows: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = _lower_bytes(frame["text"])
            for part in batches(texts, _BATCH_BYTES):
                sets = list(shingle_sets(texts[part], width))
                n = np.array([len(s) for s in sets], np.int64)
                keys: list = [[]] * len(sets)
                full = np.flatnonzero(n)
                for i, k in zip(
                    full, band_keys(signatures([sets[i] for i in full], bands * rows), bands, rows), strict=True
                ):
                    keys[i] = k.view(np.int64)
                once = [s.sum(dtype=np.uint64) for s in sets]
                twice = [np.bitwise_xor.reduce(mix(s + np.uint64(1))) if len(s) else np.uint64(0) for s in sets]
                yield pd.DataFrame(
                    {
                        "doc_id": frame["doc_id"].iloc[part],
                        "n_shingles": n,
                        "set_a": np.array(once, np.uint64).view(np.int64),
                        "set_b": np.array(twice, np.uint64).view(np.int64),
                        "bands": keys,
                        "parity": [parity_map(s) for s in sets],
                    }
                )

    return run


def _full_sets(width: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = _lower_bytes(frame["text"])
            for part in batches(texts, _BATCH_BYTES):
                sets = [s.view(np.int64) for s in shingle_sets(texts[part], width)]
                yield pd.DataFrame({"doc_id": frame["doc_id"].iloc[part], "shingles": sets})

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """u and v, the labels, of those pairs (a, b) whose full sets meet the similarity, counted on both whole sets."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.join(right, "b")
        .join(left, "a")
        .withColumn("both", both)
        .filter(F.col("both") * 100 >= percent * (F.size("sa") + F.size("sb") - F.col("both")))
        .select("u", "v")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, with one row for each row of ``docs``.

    Two documents are linked if ``100 * intersection >= percent * union`` of their
    shingle sets; component_id is the smallest id that links reach, and kept marks the
    row that stays. At a similarity of exactly 0.8 the 40 bands of 6 rows miss a pair
    with a probability of 5e-6.

    * Equal sets collapse to their smallest id before any band is made, with
      map-side minima, so a group of copies costs its rows once.
    * In each of a few rounds every bucket has a pivot, first the set that meets most
      others, and every set meets one pivot of its buckets. What a round links is
      contracted: a link joins two labels, and sets of one label never meet again.
      After the rounds only sets of a bucket with different labels meet, in buckets
      parted by size, since sets of unlike size are never similar.
    * Components are found once, over the links between labels.
    * Nulls: a null text is empty; empty texts have no shingles and link with nothing.
      A row without an id has no component and stays (kept is true). Rows that repeat
      an id and text are one document; texts that differ under one id are compared each,
      and the id stands for all of them. An empty table gives an empty result.
      Only the two named columns of ``docs`` are read, so others of any name never clash.
    """
    base = id_and_text(docs, id_col, text_col)
    signed = stored(
        base.mapInPandas(
            _sign(width, bands, rows),
            "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, parity array<long>",
        ),
        "minhash",
    )
    key = ["set_a", "set_b", "n_shingles"]
    usable = signed.filter("n_shingles > 0 and doc_id is not null")
    reps = stored(usable.groupBy(*key).agg(F.min(F.struct("doc_id", "bands", "parity")).alias("r")), "reps")
    sized = reps.select(F.col("r.doc_id").alias("rep"), F.col("n_shingles").alias("n"), F.col("r.parity").alias("parity"))
    entries = reps.select(F.explode("r.bands").alias("key"), F.col("r.doc_id").alias("rep"))
    crowded = entries.groupBy("key").agg(F.count("*").alias("crowd")).filter("crowd > 1")
    # how many others a set meets over all its buckets: what copies were made from meets most
    met = entries.join(crowded, "key").groupBy("rep").agg(F.collect_list("key").alias("keys"), F.sum("crowd").alias("reach"))
    members = stored(met.join(sized, "rep"), "members")  # the bands of a set are its keys at most
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    sets = stored(
        base.join(wanted, "doc_id", "left_semi").mapInPandas(_full_sets(width), "doc_id long, shingles array<long>"),
        "sets",
    )
    labels, spent, edges = None, [signed, reps, members, sets], []
    # a pair that is similar enough is of like size, and its parity maps differ in few bits
    bits = " + ".join(f"bit_count(parity[{i}] ^ parity_m[{i}])" for i in range(PARITY_WORDS))
    fits = f"100 * least(n, m) >= {percent} * greatest(n, m) and {100 + percent} * ({bits}) <= {100 - percent} * (n + m)"
    for turn in range(PIVOT_ROUNDS):
        named = _named(members, labels).select("*", F.explode("keys").alias("key"), _order(turn).alias("order"))
        pivot = named.groupBy("key").agg(
            F.max_by(F.struct("rep", "n", "label", "order", "parity"), "order").alias("p"),
            F.min("label").alias("lo"),
            F.max("label").alias("hi"),
        )
        pivot = pivot.filter("lo < hi").select("key", "p.*").toDF("key", "a", "m", "pivot_label", "pivot_order", "parity_m")
        # of the pivots in its buckets each set meets one, so a round has no more pairs than sets
        pairs = stored(
            named.join(pivot, "key")
            .filter("label <> pivot_label").filter(fits)
            .groupBy(F.col("rep").alias("b")).agg(F.max_by(F.struct("a", "pivot_label", "label"), "pivot_order").alias("at"))
            .select("b", "at.a", F.col("at.label").alias("v"), F.col("at.pivot_label").alias("u")),
            "pairs",
        )
        found = stored(_verified(pairs, sets, percent), "edges")
        asked, confirmed = pairs.count(), found.count()
        discard(pairs)
        edges.append(found)
        if confirmed:
            before, labels = labels, stored(_relabelled(labels, found), "labels")
            spent += [before] if before is not None else []
        if confirmed <= WORTH * asked:
            break
    # pairs of different labels; the larger set of a pair, or the later of equals, looks for the other
    size_class = F.floor(F.log("n") / F.lit(log(100 / percent) if percent < 100 else 1.0))
    named = _named(members, labels).select("rep", "n", "label", "parity", size_class.alias("size"), F.explode("keys").alias("key"))
    open_keys = named.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("key")
    named = stored(named.join(open_keys, "key"), "open")
    other = named.select(
        "key", "size", F.col("rep").alias("a"), F.col("n").alias("m"), F.col("label").alias("u"), F.col("parity").alias("parity_m")
    )
    rest = (
        named.select("key", "rep", "n", F.col("label").alias("v"), "parity", F.explode(F.array("size", F.col("size") - 1)).alias("size"))
        .join(other, ["key", "size"])
        .filter("(n > m or (n = m and rep > a)) and u <> v").filter(fits)
        .select("a", F.col("rep").alias("b"), "u", "v")
        .distinct()
    )
    edges.append(stored(_verified(rest, sets, percent), "edges"))
    linked = edges[0]
    for more in edges[1:]:
        linked = linked.union(more)
    if labels is not None:
        labels = _followed(labels)
    whole = components(_contracted(linked, labels))
    if labels is None:
        nodes = whole
    else:
        # what was contracted follows its label; labels that no link joined further stand for themselves
        nodes = labels.select("node", F.col("label").alias("old")).join(whole.withColumnRenamed("node", "old"), "old", "left")
        nodes = nodes.select("node", F.coalesce("label", "old").alias("label"))
        nodes = nodes.union(whole.join(labels, "node", "left_anti"))
    classes = reps.join(nodes.select(F.col("node").alias("doc_id"), "label"), F.col("r.doc_id") == F.col("doc_id"), "left")
    classes = classes.select(*key, F.coalesce("label", "r.doc_id").alias("component_id"))
    result = (
        signed.drop("bands", "parity")
        .join(classes, key, "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        )
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
    result = stored(result, "near_duplicates")
    discard(*spent, named, *edges, *([] if labels is None else [labels]))
    return result


def _order(turn: int) -> Column:
    """What makes a set the pivot of a round: its reach, then its age, then a hash."""
    by = (F.col("reach"), -F.col("rep"))[turn] if turn < 2 else F.xxhash64("rep", F.lit(turn))
    return F.struct(by.alias("by"), (-F.col("rep")).alias("older"))


def _named(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The members with their label, a set of the same component; at first each its own."""
    if labels is None:
        return members.withColumn("label", F.col("rep"))
    labels = labels.select(F.col("node").alias("rep"), "label")
    return members.join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep"))


def _relabelled(labels: DataFrame | None, found: DataFrame) -> DataFrame:
    """Labels (node, label) after every label of ``found`` (u, v) went to the smallest it is linked with, two steps on.

    A label goes to a smaller one only, so chains end; :func:`_followed` walks them, and
    what is left apart is joined by the components at the end.
    """
    both = found.select(F.greatest("u", "v").alias("node"), F.least("u", "v").alias("label"))
    hook = both.groupBy("node").agg(F.min("label").alias("label"))
    next_ = hook.select(F.col("node").alias("label"), F.col("label").alias("further"))
    hook = hook.join(next_, "label", "left").select("node", F.coalesce("further", "label").alias("label"))
    if labels is None:
        return hook
    moved = labels.join(hook.select(F.col("node").alias("label"), F.col("label").alias("further")), "label", "left")
    moved = moved.select("node", F.coalesce("further", "label").alias("label"))
    return moved.union(hook.join(labels, "node", "left_anti"))


def _followed(labels: DataFrame) -> DataFrame:
    """Labels that no label of their own moves further, by pointer doubling."""
    while True:
        further = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        if labels.join(further, "label", "left_semi").isEmpty():
            return labels
        before = labels
        labels = stored(labels.join(further, "label", "left").select("node", F.coalesce("further", "label").alias("label")), "labels")
        discard(before)


def _contracted(edges: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Links (u, v) between the present labels of their ends."""
    edges = edges.select("u", "v")
    if labels is None:
        return edges
    for end in ("u", "v"):
        now = labels.select(F.col("node").alias(end), F.col("label").alias(f"{end}_now"))
        edges = edges.join(now, end, "left").withColumn(end, F.coalesce(f"{end}_now", end)).drop(f"{end}_now")
    return edges.filter("u <> v").distinct()
