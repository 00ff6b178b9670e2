"""Sequence packing: first-fit decreasing over a tournament tree, in randomised groups."""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, stored
from .textarrays import batches
from .tokens import default_tokenizer, tokenizer

CAPACITY = 2048
END_ID = 1
#: Pieces that one group holds on average; a group is packed by one task.
GROUP_PIECES = 8192
_BATCH_BYTES = 4 << 20


def _cut(path: str, capacity: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = tokenizer(path)
        for frame in frames:
            texts = frame["text"].tolist()
            ids = frame["doc_id"].tolist()
            rows = []
            for part in batches(texts, _BATCH_BYTES):
                for doc_id, body in zip(ids[part], tok.encode(texts[part]), strict=True):
                    body += end
                    total = len(body) // 4
                    for a in range(0, total, capacity):
                        piece = body[4 * a : 4 * (a + capacity)]
                        rows.append((doc_id, a, len(piece) // 4, crc32(piece), total))
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"]).astype(
                {"doc_id": "Int64"}
            )

    return run


def pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    tokenizer_path: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: each document cut every ``capacity`` ids."""
    return id_and_text(docs, id_col, text_col).mapInPandas(
        _cut(tokenizer_path or default_tokenizer(), capacity, end_id),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long",
    )


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset of each length, longest first, each into the first bin with room.

    The bins' free room are the leaves of a complete binary tree whose inner nodes
    hold the larger of their children (a tournament), so the first bin with room is
    found by one walk down and the tree is mended by one walk up.
    """
    n = len(lengths)
    leaves = 1
    while leaves < max(n, 1):
        leaves *= 2
    # leaf i covers bin i; an untouched bin has all its room
    tree = [capacity] * (2 * leaves)
    where, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < need:
                node += 1
        room = tree[node]
        where[i], offset[i] = node - leaves, capacity - room
        tree[node] = room - need
        node //= 2
        while node:
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
            node //= 2
    return where, offset


def _pack_group(capacity: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable")
        where, offset = first_fit_decreasing(frame["length"].to_numpy(), capacity)
        frame["sequence_id"] = (frame["pack_group"].to_numpy(np.int64) << 32) + where
        frame["offset"] = offset
        return frame[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    return run


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    tokenizer_path: str | None = None,
    end_id: int = END_ID,
    group_pieces: int = GROUP_PIECES,
    seed: int = 7,
) -> DataFrame:
    """Pieces with their sequence: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids, with ``end_id`` after them, are cut every ``capacity`` ids. The
    pieces are dealt to groups by a salted hash of the piece and its number in the
    stored table, about ``group_pieces`` in each, so equal rows are dealt apart too.
    Every group is packed on its own, so work and memory of a task stay bounded at any
    size of the input; the padding that grouping adds is at most one unfilled tail of
    bins for each group. Among pieces of one length the smaller doc_id and start come
    first. Which pieces share a sequence follows the input's partitions.

    Nulls: a null text is empty and gives one piece that holds ``end_id`` alone; a
    row without an id is packed too. Rows that repeat are packed each. A long text
    fills as many pieces as it needs. Only the two named columns of ``docs`` are read,
    so others of any name never clash. An empty table gives no rows.
    """
    cut = pieces(docs, id_col, text_col, capacity, tokenizer_path, end_id)
    cut = stored(cut.withColumn("number", F.monotonically_increasing_id()), "pieces")
    groups = max(1, round(cut.count() / group_pieces))
    dealt = cut.withColumn(
        "pack_group", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "start", "ids_crc32", "number"), F.lit(groups))
    ).drop("number")
    return dealt.groupBy("pack_group").applyInPandas(
        _pack_group(capacity),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
