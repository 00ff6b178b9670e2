"""Source divergence audit: how far the sources of a language differ in their terms.

``bytes.translate`` lowers A-Z and blanks every separator of a text's UTF-8 bytes in one
pass, ``bytes.split`` cuts the terms, and a Counter of each document yields its terms and
their occurrences. Each task adds them up by group and term before anything is shuffled;
from then on only (lang, source, term) counts are handled, as a sparse table.

Distances between sources are summed over blocks of terms, each a small dense matrix of
terms by sources in one task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, stored

#: Documents of a language that hold a term, for it to be kept.
MIN_DOCS = 30
#: Added to each count, and the whole that shares are given of.
PRIOR = 5
WHOLE = 1_000_000_000
TOP_TERMS = 50
#: Distinct terms of documents that a task holds before it adds them up and passes them on.
FLUSH = 1_000_000
#: Cells of a block's matrix of terms by sources, and sources of one tile of it.
CELLS = 1 << 19
TILE = 512
#: Groups up to this number meet the counts by broadcast.
BROADCAST_GROUPS = 50_000

#: Letters lowered, bytes from 0x80 on kept, all else a blank.
TABLE = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text: runs of letters A-Z and of characters beyond ASCII, A-Z lowered."""
    return text.translate(TABLE).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n_docs, count), added up within what a task holds at once."""
    names: dict[tuple[str, str], int] = {}
    group, sizes, found, counts = [], [], [], []

    def flush() -> pa.RecordBatch:
        table = pa.table({
            "g": np.repeat(np.array(group, np.int32), sizes), "term": pa.array(found, pa.binary()), "n": pa.array(counts, pa.int64())
        }).group_by(["g", "term"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
        lang, source = (pa.array([k[i] for k in names], pa.string()) for i in (0, 1))
        g = table["g"].combine_chunks()
        out = [lang.take(g), source.take(g), table["term"].combine_chunks().cast(pa.string()), table["n_count"].combine_chunks(), table["n_sum"].combine_chunks()]
        for held in (group, sizes, found, counts):
            held.clear()
        return pa.RecordBatch.from_arrays(out, names=["lang", "source", "term", "n_docs", "count"])

    for batch in batches:
        texts = batch.column(2).cast(pa.binary())
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True):
            own = Counter(terms(text.as_py()))
            group.append(names.setdefault((lang, source), len(names)))
            sizes.append(len(own))
            found.extend(own)
            counts.extend(own.values())
            if len(found) >= FLUSH:
                yield flush()
    if found:
        yield flush()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, term, n_docs, count of every term of every group; nulls read as ''."""
    named = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    found = docs.select(*named).mapInArrow(_counted, "lang string, source string, term string, n_docs long, count long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("count").alias("count"))


def _share(count: Column, total: Column, n_terms: Column) -> Column:
    """1 + floor(WHOLE * (count + PRIOR) / (total + PRIOR * terms)), in whole decimals, as counts may exceed 64 bits times WHOLE."""
    def whole(c: Column) -> Column:
        return c.cast("decimal(19,0)")

    up = (whole(count) + F.lit(PRIOR).cast("decimal(2,0)")) * F.lit(WHOLE).cast("decimal(10,0)")
    return 1 + F.call_function("div", up, whole(total) + whole(n_terms) * F.lit(PRIOR).cast("decimal(2,0)"))


def _small(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= BROADCAST_GROUPS else df


def _distances(cells: DataFrame, groups: DataFrame, n_blocks: int) -> DataFrame:
    """lang, a, b, value: summed absolute differences of the shares of sources a and b over all kept terms.

    A block holds some of the terms, a tile pair some of the sources on either side. Every
    source sends one row with its share of an absent term to each block, every occurring
    term of a source one row with its share.
    """
    block = F.pmod(F.xxhash64("term"), F.lit(n_blocks)).cast("int")
    tiles = F.lit(TILE)
    rows = cells.select("lang", "no", "n_sources", block.alias("block"), "term", "p").unionByName(
        groups.select(
            "lang", "no", "n_sources", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"),
            F.lit(None).cast("string").alias("term"), F.col("absent").alias("p"),
        )
    )
    tile, last = F.floor(F.col("no") / tiles).cast("int"), F.floor((F.col("n_sources") - 1) / tiles).cast("int")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), last))).select(
        "lang", "block", "no", "term", "p", F.least(tile, "other").alias("x"), F.greatest(tile, "other").alias("y")
    )

    def summed(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        lang, _, x, y = key
        base = part[part.term.isna()].sort_values("no")
        no, absent = base.no.to_numpy(), base.p.to_numpy()
        found = part[part.term.notna()]
        at, names = pd.factorize(found.term)
        share = np.broadcast_to(absent, (len(names), len(no))).copy()
        share[at, np.searchsorted(no, found.no.to_numpy())] = found.p.to_numpy()
        left, right = np.flatnonzero(no // TILE == x), np.flatnonzero(no // TILE == y)
        out = [np.abs(share[:, [i]] - share[:, right]).sum(0) for i in left]
        a, b = np.repeat(no[left], len(right)), np.tile(no[right], len(left))
        value = np.concatenate(out) if out else np.zeros(0, np.int64)
        keep = a != b
        a, b, value = a[keep], b[keep], value[keep]
        if x != y:
            a, b, value = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([value, value])
        return pd.DataFrame({"lang": lang, "a": a, "b": b, "value": value})

    sums = rows.groupBy("lang", "block", "x", "y").applyInPandas(summed, "lang string, a int, b int, value long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS, top: int = TOP_TERMS
) -> DataFrame:
    """lang, source, part, item, value, rank, as the contract of op12 defines them.

    Part ``pair`` ranks the other sources of the language by summed differences of term
    shares, part ``term`` the terms that a source has more of than its language.

    Null texts, languages and sources read as ''; a document without terms still makes its
    group occur. Very long texts are counted whole. Rows that repeat count each; ids are
    not read, nor any other column. Ties go by the UTF-8 bytes of the item. A language
    without kept terms has pairs of value 0; one with a single source has no pairs. An
    empty table gives no rows. Pairs are the result, so their number grows with the square
    of a language's sources; no task holds more than a tile of them.
    """
    counts = stored(term_counts(docs, text_col, lang_col, source_col), "counts")
    by_term = counts.groupBy("lang", "term").agg(F.sum("n_docs").alias("d"), F.sum("count").alias("lang_count"))
    kept = by_term.filter(F.col("d") >= min_docs).drop("d")
    entries = stored(counts.join(kept, ["lang", "term"]), "entries")
    names = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))))
    totals = entries.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = names.distinct().join(totals, ["lang", "source"], "left").fillna(0, ["n"])
    terms_of = entries.select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("v"))
    langs = groups.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count("*").cast("int").alias("n_sources"))
    groups = groups.join(langs.join(terms_of, "lang", "left").fillna(0, ["v"]), "lang")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    absent = F.when(F.col("v") > 0, _share(F.lit(0), F.col("n"), F.col("v"))).otherwise(0)
    groups = stored(groups.select("*", place.alias("no"), absent.alias("absent")), "groups")
    discard(counts)
    n_groups = groups.count()
    known = _small(groups, n_groups)
    cells = stored(
        entries.join(known, ["lang", "source"]).select(
            "lang", "source", "term", "no", "n_sources",
            _share(F.col("count"), F.col("n"), F.col("v")).alias("p"), _share(F.col("lang_count"), F.col("lang_n"), F.col("v")).alias("q"),
        ),
        "cells",
    )
    discard(entries)

    size = groups.groupBy("lang").agg((F.max("v") * F.least(F.max("n_sources"), F.lit(TILE))).alias("c")).agg(F.max("c")).first()[0] or 0
    sums = _distances(cells, groups, max(1, -(-size // CELLS)))
    ours = _small(groups.select("lang", "source", F.col("no").alias("a")), n_groups)
    theirs = _small(groups.select("lang", F.col("source").alias("item"), F.col("no").alias("b")), n_groups)
    pairs = sums.join(ours, ["lang", "a"]).join(theirs, ["lang", "b"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    more = cells.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    ranked = more.select("*", rank).filter(F.col("rank") <= top)
    return pairs.select("*", rank).unionByName(ranked)
