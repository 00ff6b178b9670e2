"""Approximate nearest neighbours by inner product: a hierarchical k-means tree.

The tree is fitted on a bounded sample; every row is indexed under the leaf that a descent
to the nearest centre reaches. A query walks the tree best bin first: a priority queue of
nodes by their centre's inner product with the query, from which leaves come out in the
order they are to be visited. How many a query visits is calibrated: the exact neighbours
of some queries are found by brute force, and the visits widen leaf by leaf until these
queries meet the asked recall.

Leaves of many rows are dealt to several tasks, and so are their queries; scores are
products of bounded blocks. The first visits of a query set the score below which later
ones return nothing.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, stored
from .vector_codes import usable

NEIGHBOURS = 20
QUERY_EVERY = 20
#: Recall of the calibrating queries that ends the widening.
TARGET = 0.95
#: Components of the sample that the tree is fitted on (32,768 rows of 64), a bound on the driver's share.
SAMPLE_VALUES = 1 << 21
#: Rows of a leaf that the tree aims at, and its leaves at most.
LEAF_ROWS = 512
MAX_LEAVES = 4096
BRANCH = 8
LLOYD_ROUNDS = 8
#: Queries whose exact neighbours calibrate the visits, rows of a scored block, queries of one.
CALIBRATING = 128
ROWS = 2048
QUERIES = 1024
SEED = 17


@dataclass(frozen=True)
class Tree:
    """Centres of all nodes; node 0 is the root. Children of a node lie next to each other."""

    centres: np.ndarray
    first: np.ndarray  # first child, -1 at leaves
    many: np.ndarray  # number of children
    leaf: np.ndarray  # number of the leaf, -1 elsewhere

    @property
    def n_leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf that a descent to the nearest centre reaches from the root, for each row."""
        at = np.zeros(len(x), np.int64)
        while (open_rows := np.flatnonzero(self.first[at] >= 0)).size:
            for node in np.unique(at[open_rows]):
                rows = open_rows[at[open_rows] == node]
                c = self.centres[self.first[node] : self.first[node] + self.many[node]]
                at[rows] = self.first[node] + ((c * c).sum(1) - 2 * (x[rows] @ c.T)).argmin(1)
        return self.leaf[at]

    def visits(self, q: np.ndarray, n: int, rows_of: list[int], need: int) -> list[list[int]]:
        """Leaves of each query, best bin first: ``n`` of them, or more until they hold ``need`` rows."""
        out = []
        first, many, leaf = self.first.tolist(), self.many.tolist(), self.leaf.tolist()
        for at in range(0, len(q), 256):
            for score in (q[at : at + 256] @ self.centres.T).tolist():
                queue, found, seen = [(-score[0], 0)], [], 0
                while queue and (len(found) < n or seen < need):
                    node = heapq.heappop(queue)[1]
                    if first[node] < 0:
                        found.append(leaf[node])
                        seen += rows_of[leaf[node]]
                    else:
                        for child in range(first[node], first[node] + many[node]):
                            heapq.heappush(queue, (-score[child], child))
                out.append(found)
        return out


def _means(x: np.ndarray, k: int, random: np.random.Generator) -> np.ndarray:
    """Cluster of each row by a few rounds of Lloyd's algorithm from k different rows; fewer where rows repeat."""
    centres = np.unique(x[random.permutation(len(x))[: 4 * k]], axis=0)
    centres = centres[random.permutation(len(centres))[:k]]
    for _ in range(LLOYD_ROUNDS):
        own = ((centres * centres).sum(1) - 2 * (x @ centres.T)).argmin(1)
        used, own = np.unique(own, return_inverse=True)
        count = np.bincount(own)
        centres = np.stack([np.bincount(own, x[:, j]) for j in range(x.shape[1])], axis=1) / count[:, None]
    return own


def fit(sample: np.ndarray, leaves: int, seed: int = SEED) -> Tree:
    """Split the node of the most sample rows in up to BRANCH clusters until there are ``leaves`` leaves.

    A node whose rows are all alike stays a leaf; without rows the tree is one leaf.
    """
    random = np.random.default_rng(seed)
    x = sample.astype(np.float64)
    centres, first, many = [x.mean(0) if len(x) else np.zeros(sample.shape[1])], [-1], [0]
    queue, open_leaves = [(-len(x), 0, np.arange(len(x)))], 1
    while queue and open_leaves < leaves:
        _, node, rows = heapq.heappop(queue)
        own = _means(x[rows], BRANCH, random) if len(rows) > 1 else np.zeros(len(rows), np.int64)
        k = int(own.max(initial=0)) + 1
        if k == 1:
            continue
        first[node], many[node] = len(centres), k
        for c in range(k):
            part = rows[own == c]
            heapq.heappush(queue, (-len(part), len(centres), part))
            centres.append(x[part].mean(0))
            first.append(-1)
            many.append(0)
        open_leaves += k - 1
    begin = np.array(first)
    leaf = np.where(begin < 0, np.cumsum(begin < 0) - 1, -1)
    return Tree(np.array(centres), begin, np.array(many), leaf)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _numbers(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner product of each pair of rows in doubles, added from the first component to the last."""
    total = np.zeros(len(q))
    for j in range(q.shape[1]):
        total += q[:, j] * x[:, j]
    return total


def best_of_block(
    q: np.ndarray, q_row: np.ndarray, least: np.ndarray, x: np.ndarray, x_row: np.ndarray, x_id: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows of the block for each query: index of the query, index of the row, score.

    Best is the largest inner product, ties to the smaller id, then row; a query's own row
    and scores below ``least`` do not count. Equal vectors are scored once: of each the
    k + 1 first are enough. A fast product finds who can be among the best, within its
    rounding; :func:`products` then gives the scores that decide.
    """
    order = np.lexsort((x_row, x_id))
    x, x_row, x_id = x[order], x_row[order], x_id[order]
    distinct, own = np.unique(x, axis=0, return_inverse=True)
    own = own.ravel()
    by_vector = np.argsort(own, kind="stable")
    starts = np.searchsorted(own[by_vector], np.arange(len(distinct)))
    sizes = np.minimum(np.diff(np.append(starts, len(own))), k + 1)
    fast = q @ distinct.T
    slack = 1e-13 * len(q[0]) * np.sqrt((q * q).sum(1)) * np.sqrt((distinct * distinct).sum(1).max())
    floor = np.maximum(np.partition(fast, -k - 1, axis=1)[:, -k - 1] if len(distinct) > k else -np.inf, least) - 2 * slack
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for at in range(0, len(q), 128):
        qi, di = np.nonzero(fast[at : at + 128] >= floor[at : at + 128, None])
        qi += at
        score = np.concatenate([products(q[qi[i : i + 65536]], distinct[di[i : i + 65536]]) for i in range(0, len(qi), 65536)] or [np.zeros(0)])
        keep = score >= least[qi]
        qi, di, score = qi[keep], di[keep], score[keep]
        n = sizes[di]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        xi = by_vector[np.repeat(starts[di], n) + nth]
        qi, score = np.repeat(qi, n), np.repeat(score, n)
        keep = q_row[qi] != x_row[xi]
        qi, xi, score = qi[keep], xi[keep], score[keep]
        rank = np.lexsort((xi, -score, qi))  # rows are in order of id and row
        qi, xi, score = qi[rank], xi[rank], score[rank]
        nth = np.arange(len(qi)) - np.searchsorted(qi, qi)
        found.append((qi[nth < k], order[xi[nth < k]], score[nth < k]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


FOUND = "query long, query_id long, vec_row long, vec_id long, score double"


def _scored(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """Rows of a part of a leaf against queries that visit it."""
    names = [c.split()[0] for c in FOUND.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.float64()]
    if not (left.num_rows and right.num_rows):
        return pa.table([pa.array([], t) for t in kinds], names=names)
    x_row, x_id, q_row, q_id = (_numbers(t[c]) for t in (left, right) for c in ("row", "vec_id"))
    least = _numbers(right["least"])
    qi, xi, score = best_of_block(_matrix(right["vector"]), q_row, least, _matrix(left["vector"]), x_row, x_id, k)
    return pa.table([pa.array(c, t) for c, t in zip((q_row[qi], q_id[qi], x_row[xi], x_id[xi], score), kinds, strict=True)], names=names)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "vec_row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def exact(rows: DataFrame, queries: list, k: int = NEIGHBOURS) -> DataFrame:
    """Neighbours of a bounded list of queries (row, vec_id, vector) against all rows, block by block."""
    q = np.array([r.vector for r in queries], np.float64)
    q_row, q_id = (np.array([r[c] for r in queries], np.int64) for c in ("row", "vec_id"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                b = batch.slice(at, ROWS)
                x_row, x_id = _numbers(b.column("row")), _numbers(b.column("vec_id"))
                qi, xi, score = best_of_block(q, q_row, np.full(len(q), -np.inf), _matrix(b.column("vector")), x_row, x_id, k)
                leaf = _numbers(b.column("leaf"))[xi]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (q_row[qi], q_id[qi], x_row[xi], x_id[xi], score, leaf)], names=[*(c.split()[0] for c in FOUND.split(", ")), "leaf"])

    return _best(rows.select("row", "vec_id", "vector", "leaf").mapInArrow(scan, FOUND + ", leaf long"), k)


def calibrated(tree: Tree, queries: list, found: list, rows_of: list[int], target: float) -> tuple[int, float]:
    """Leaf visits that reach ``target``, and the recall of the calibrating queries with them.

    ``found`` holds (query, leaf) of the exact neighbours. Visits widen by a leaf at a time.
    """
    if not found:
        return 1, 1.0
    orders = tree.visits(np.array([r.vector for r in queries], np.float64), tree.n_leaves, rows_of, 0)
    place = {r.row: {leaf: i for i, leaf in enumerate(o)} for r, o in zip(queries, orders, strict=True)}
    at = np.bincount([place[r.query][r.leaf] for r in found], minlength=tree.n_leaves)
    n, met = 1, int(at[0])
    while met < target * len(found):
        met += int(at[n])
        n += 1
    return n, met / len(found)


@dataclass(frozen=True)
class Index:
    """All usable rows under their leaves (row, vec_id, vector, leaf), the tree, and the rows of each leaf."""

    rows: DataFrame
    tree: Tree
    rows_of: list[int]


def build(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", leaf_rows: int = LEAF_ROWS) -> Index | None:
    """Index every usable row; None if there is none. See :func:`nearest` for what is usable."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("vector")).filter(
        F.col("vec_id").isNotNull() & usable(F.col("vector")) & F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False))
    )
    n, least, most = rows.agg(F.count("*"), F.min(F.size("vector")), F.max(F.size("vector"))).first()
    if not n:
        return None
    if least != most:
        raise ValueError(f"vectors of {least} to {most} components")
    share = SAMPLE_VALUES / most / n
    sample = rows.select("vector") if share >= 1 else rows.select("vector").sample(share, SEED)
    x = _matrix(sample.toArrow()["vector"])  # SAMPLE_VALUES components or so
    tree = fit(x.reshape(-1, most), max(1, min(MAX_LEAVES, n // leaf_rows)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.assign(_matrix(batch.column("vector"))) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int64())], names=["vec_id", "vector", "leaf"])

    kind = dict(rows.dtypes)["vector"]
    placed = rows.mapInArrow(place, f"vec_id long, vector {kind}, leaf long").withColumn("row", F.monotonically_increasing_id())
    placed = stored(placed, "leaves")
    rows_of = [0] * tree.n_leaves
    for leaf, count in placed.groupBy("leaf").count().collect():  # MAX_LEAVES rows
        rows_of[leaf] = count
    return Index(placed, tree, rows_of)


def _parts(spark, counts: dict[int, int], size: int, name: str) -> DataFrame:
    """leaf, number of parts of about ``size``: as many rows as leaves."""
    return F.broadcast(spark.createDataFrame([(leaf, -(-n // size)) for leaf, n in counts.items() if n], f"leaf long, {name} long"))


def _visited(index: Index, routes: DataFrame, k: int) -> DataFrame:
    """Best rows of each visited part of a leaf for ``routes`` (row, vec_id, vector, least, leaves)."""
    spark = routes.sparkSession
    visits = routes.withColumn("leaf", F.explode("leaves")).drop("leaves")
    asked = {leaf: n for leaf, n in routes.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect()}
    x_parts = _parts(spark, dict(enumerate(index.rows_of)), ROWS, "x_parts")
    q_parts = _parts(spark, asked, QUERIES, "q_parts")

    def dealt(df: DataFrame, own: str, other: str, own_parts: str, other_parts: str) -> DataFrame:
        df = df.join(x_parts, "leaf").join(q_parts, "leaf").withColumn(own, F.pmod(F.xxhash64("row"), own_parts))
        return df.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other_parts) - 1))).drop("x_parts", "q_parts")

    left = dealt(index.rows, "x", "q", "x_parts", "q_parts").groupBy("leaf", "x", "q")
    right = dealt(visits, "q", "x", "q_parts", "x_parts").groupBy("leaf", "x", "q")
    return left.cogroup(right).applyInArrow(lambda a, b: _scored(a, b, k), FOUND)


def search(index: Index, queries: DataFrame, k: int = NEIGHBOURS, target: float = TARGET) -> tuple[DataFrame, int, float]:
    """Neighbours of ``queries`` (rows of the index): query, query_id, rank, vec_id, score; leaf visits; calibrated recall."""
    tree, rows_of = index.tree, index.rows_of
    some = queries.orderBy(F.xxhash64("row"), "row").limit(CALIBRATING).collect()  # CALIBRATING rows
    n_visits, recall = calibrated(tree, some, exact(index.rows, some, k).select("query", "leaf").collect() if some else [], rows_of, target)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = tree.visits(_matrix(batch.column("vector")), n_visits, rows_of, k + 1) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves, pa.list_(pa.int64()))], names=["row", "vec_id", "vector", "leaves"])

    kind = dict(queries.dtypes)["vector"]
    routes = stored(queries.select("row", "vec_id", "vector").mapInArrow(route, f"row long, vec_id long, vector {kind}, leaves array<long>"), "routes")
    # enough leaves at first for k rows to set a bar
    begin = max(1, n_visits // 8)
    early = routes.withColumn("leaves", F.slice("leaves", 1, begin)).withColumn("least", F.lit(float("-inf")))
    first = stored(_best(_visited(index, early, k), k).drop("rank"), "first")
    bar = first.groupBy("query").agg(F.when(F.count("*") >= k, F.min("score")).alias("bar"))
    rest = routes.filter(F.size("leaves") > begin).withColumn("leaves", F.slice("leaves", begin + 1, F.size("leaves")))
    rest = rest.join(bar, rest["row"] == bar["query"], "left").withColumn("least", F.coalesce("bar", F.lit(float("-inf")))).drop("bar", "query")
    second = stored(_visited(index, rest, k), "second")
    found = stored(_best(first.unionByName(second), k), "neighbours")
    discard(routes, first, second)
    return found.select("query", "query_id", "rank", "vec_id", "score"), n_visits, recall


def nearest(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEIGHBOURS, every: int = QUERY_EVERY, target: float = TARGET
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each row whose id ``every`` divides.

    Nearness is the inner product in doubles; ties go to the smaller id. A query visits as
    many leaves as calibration asks for, and more until they hold k other rows, so it
    gets k neighbours wherever there are as many other rows.

    Rows whose vector is null, empty, zero or holds a null or a component that is no finite number take no
    part, nor do rows without an id. Rows that repeat an id are rows of their own: each
    is a query if its id is, and a candidate for the others. Other columns are never read.
    A table without usable rows gives none. Vectors of several lengths raise ValueError.
    """
    index = build(vectors, id_col, vector_col)
    if index is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found, _, _ = search(index, index.rows.filter(F.col("vec_id") % every == 0), k, target)
    discard(index.rows)
    return found.select("query_id", "rank", "vec_id", "score")
