"""Token counts of flat token files by a vectorised search for end-of-document ids."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import id_and_text, stored
from .textarrays import batches
from .tokens import default_tokenizer, tokenizer

END_ID = 49407
BLOCK_TOKENS = 1 << 14
_BATCH_BYTES = 2 << 20
#: Bytes of a row group of stored blocks, which a writer holds in memory.
_ROW_GROUP = 16 << 20
#: Pages of blocks that one window of the prefix scan covers before pages are summed themselves.
PAGE_BLOCKS = 4096
#: Blocks of a file that one range of :func:`read_token_files` covers.
RANGE_BLOCKS = 1024


def _flatten(path: str, end_id: int, block_tokens: int):
    """Append ids to the task's flat file and hand it on block by block, cut at any token."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        tok, file_id = tokenizer(path, True), TaskContext.get().partitionId()
        end, width = np.array([end_id], "<u4").tobytes(), 4 * block_tokens
        held, held_ids, block_no = bytearray(), [], 0
        starts: list[int] = []  # byte positions in ``held`` where a held document's separator begins
        for frame in frames:
            texts, ids = frame["text"].tolist(), frame["doc_id"].tolist()
            for part in batches(texts, _BATCH_BYTES):
                for doc_id, body in zip(ids[part], tok.encode(texts[part]), strict=True):
                    held += body
                    starts.append(len(held))
                    held_ids.append(doc_id)
                    held += end
                done = len(held) // width
                rows = []
                for k in range(done):
                    n = np.searchsorted(starts, (k + 1) * width) - np.searchsorted(starts, k * width)
                    rows.append((file_id, block_no, bytes(held[k * width : (k + 1) * width]), held_ids[:n]))
                    held_ids, block_no = held_ids[n:], block_no + 1
                if rows:
                    del held[: done * width]
                    starts = [s - done * width for s in starts if s >= done * width]
                    yield pd.DataFrame(rows, columns=["file_id", "block_no", "ids", "doc_ids"])
        if held:
            yield pd.DataFrame([(file_id, block_no, bytes(held), held_ids)], columns=["file_id", "block_no", "ids", "doc_ids"])

    return run


def flat_blocks(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_path: str | None = None,
    end_id: int = END_ID,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Flat token files of ``docs``, one for each input partition, as a table of fixed-size blocks.

    file_id, block_no, ids (little-endian unsigned 32-bit ids, documents joined with
    ``end_id`` after each and cut anywhere), doc_ids (the documents that end in the
    block, the file's manifest). Special strings inside texts are ordinary text, so
    only separators have ``end_id``.
    """
    return id_and_text(docs, id_col, text_col).mapInPandas(
        _flatten(tokenizer_path or default_tokenizer(), end_id, block_tokens),
        "file_id long, block_no long, ids binary, doc_ids array<long>",
    )


def read_token_files(
    spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS, token_bytes: int = 4, by_ranges: bool = True
) -> DataFrame:
    """Blocks of existing flat files of little-endian unsigned ids of 2 or 4 bytes.

    Spark lists the files; each is cut in ranges of RANGE_BLOCKS blocks, the ranges
    are dealt to tasks, and a task reads its ranges a block at a time through
    ``pyarrow.fs``, so a file may be of any size. A store that pyarrow cannot open
    needs ``by_ranges=False``: Spark then reads each file whole in one task, which
    holds for files below 2 GB. file_id is the file's path; an empty file gives no block.
    """
    kind = {2: "<u2", 4: "<u4"}[token_bytes]
    step = token_bytes * block_tokens
    columns = ["file_id", "block_no", "ids"]
    schema = "file_id string, block_no long, ids binary"

    def block(name: str, number: int, raw: bytes) -> pd.DataFrame:
        ids = np.frombuffer(raw, kind).astype("<u4").tobytes()
        return pd.DataFrame([(name, number, ids)], columns=columns)

    def whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                for k, a in enumerate(range(0, len(content), step)):
                    yield block(name, k, content[a : a + step])

    def ranges(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for frame in frames:
            for name, first, last in zip(frame["path"], frame["first"], frame["last"], strict=True):
                store, inside = fs.FileSystem.from_uri(quote(re.sub("^file:/+", "file:///", name), safe="/:@"))
                with store.open_input_file(inside) as f:
                    for k in range(first, last):
                        yield block(name, k, f.read_at(step, k * step))

    files = spark.read.format("binaryFile").load(path)
    if not by_ranges:
        return files.select("path", "content").mapInPandas(whole, schema)
    blocks = F.ceil(F.col("length") / step)
    pieces = files.select("path", blocks.alias("blocks")).filter("blocks > 0").select(
        "path", "blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1, F.lit(RANGE_BLOCKS).cast("long"))).alias("first")
    )
    pieces = pieces.select("path", "first", F.least("blocks", F.col("first") + RANGE_BLOCKS).alias("last"))
    # without a count the range of each hash is left to the session and to adaptive execution
    return pieces.repartition("path", "first").mapInPandas(ranges, schema)


def _search(end_id: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out, blocks = frame.drop(columns="ids"), frame["ids"].tolist()
            del frame
            n, found = [], []
            for block in blocks:
                ids = np.frombuffer(block, "<u4")
                n.append(len(ids))
                found.append(np.flatnonzero(ids == end_id))
            out["n_tokens"], out["ends"] = n, found
            yield out

    return run


def separator_scan(blocks: DataFrame, end_id: int = END_ID, page_blocks: int = PAGE_BLOCKS) -> DataFrame:
    """Documents of flat token files: file_id, doc_no, doc_id, start, n_tokens, complete.

    ``blocks`` has file_id, block_no and ids, and may have doc_ids. Each block is
    searched at once for ``end_id``; what crosses a block's edge is stitched by a
    prefix scan over the blocks' token counts, separator counts and last separators.
    The scan is two-level: within pages of ``page_blocks`` blocks, then over pages, so
    a very large file is spread over many tasks. start and n_tokens are in tokens and
    n_tokens leaves out the separator; what follows a file's last separator is a
    document with complete = false. doc_no counts from 0 in its file. Null or empty
    blocks hold no tokens. An empty table gives no rows.
    """
    kind = dict(blocks.dtypes)["file_id"]
    given = blocks.withColumn("ids", F.coalesce("ids", F.lit(b"")))
    if "doc_ids" not in blocks.columns:
        given = given.withColumn("doc_ids", F.lit(None).cast("array<long>"))
    found = (
        given.select("file_id", "block_no", "ids", "doc_ids")
        .mapInPandas(_search(end_id), f"file_id {kind}, block_no long, doc_ids array<long>, n_tokens long, ends array<long>")
        .withColumn("page", F.floor(F.col("block_no") / page_blocks))
        .withColumn("n_ends", F.size("ends").cast("long"))
        .withColumn("last_end", F.when(F.size("ends") > 0, F.element_at(F.col("ends"), -1)))
    )
    found = stored(found, "scan")
    before = W.partitionBy("file_id", "page").orderBy("block_no").rowsBetween(W.unboundedPreceding, -1)
    local = (
        found.withColumn("t0", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
        .withColumn("d0", F.coalesce(F.sum("n_ends").over(before), F.lit(0)))
        .withColumn("end_at", F.col("t0") + F.col("last_end"))
        .withColumn("e0", F.max("end_at").over(before))
    )
    pages = local.groupBy("file_id", "page").agg(
        F.sum("n_tokens").alias("pt"), F.sum("n_ends").alias("pd"), F.max("end_at").alias("pe")
    )
    earlier = W.partitionBy("file_id").orderBy("page").rowsBetween(W.unboundedPreceding, -1)
    pages = (
        pages.withColumn("page_t", F.coalesce(F.sum("pt").over(earlier), F.lit(0)))
        .withColumn("page_d", F.coalesce(F.sum("pd").over(earlier), F.lit(0)))
        .withColumn("page_e", F.max(F.col("page_t") + F.col("pe")).over(earlier))
        .select("file_id", "page", "page_t", "page_d", "page_e")
    )
    at = local.join(pages, ["file_id", "page"]).select(
        "file_id",
        "doc_ids",
        "ends",
        (F.col("page_t") + F.col("t0")).alias("base"),
        (F.col("page_d") + F.col("d0")).alias("docs"),
        F.coalesce(F.col("page_t") + F.col("e0"), "page_e", F.lit(-1)).alias("open_end"),
    )
    whole = (
        at.select("*", F.posexplode("ends").alias("i", "at"))
        .withColumn("end", F.col("base") + F.col("at"))
        .withColumn("start", F.when(F.col("i") == 0, F.col("open_end") + 1).otherwise(F.col("base") + F.try_element_at("ends", F.col("i")) + 1))
        .select(
            "file_id",
            (F.col("docs") + F.col("i")).alias("doc_no"),
            F.try_element_at("doc_ids", F.col("i") + 1).alias("doc_id"),
            "start",
            (F.col("end") - F.col("start")).alias("n_tokens"),
            F.lit(True).alias("complete"),
        )
    )
    files = pages.join(
        local.groupBy("file_id", "page").agg(F.sum("n_tokens").alias("pt"), F.sum("n_ends").alias("pd"), F.max("end_at").alias("pe")),
        ["file_id", "page"],
    ).groupBy("file_id").agg(
        F.sum("pt").alias("tokens"), F.sum("pd").alias("docs"), F.max(F.col("page_t") + F.col("pe")).alias("last")
    )
    tail = files.withColumn("start", F.coalesce("last", F.lit(-1)) + 1).filter("start < tokens").select(
        "file_id", F.col("docs").alias("doc_no"), F.lit(None).cast("long").alias("doc_id"), "start",
        (F.col("tokens") - F.col("start")).alias("n_tokens"), F.lit(False).alias("complete"),
    )
    return whole.unionByName(tail)


def token_counts(docs: DataFrame, **options) -> DataFrame:
    """Write ``docs`` as flat token files and count each document's tokens by scanning them.

    A file is what one task writes of its input, so file_id, doc_no and start follow
    the input's partitions; doc_id, n_tokens and complete do not.

    Nulls: a null text is an empty document of 0 tokens; rows without an id and
    repeated rows are counted each. A long text runs over as many blocks as it needs.
    Only the two named columns of ``docs`` are read, so others of any name never
    clash. An empty table gives no rows.
    """
    blocks = stored(flat_blocks(docs, **options), "tokens", **{"parquet.block.size": _ROW_GROUP})
    return separator_scan(blocks, options.get("end_id", END_ID))
