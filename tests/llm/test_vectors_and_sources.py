"""Vector codes, source divergence and the k-means tree against brute-force versions."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.llm import source_divergence, vector_codes, vector_tree

VECTORS = "label int, vec_id long, embedding array<float>, vector string, leaf int"


def vectors(spark, rows):
    """rows of (vec_id, vector, label), beside columns whose names the operators use themselves."""
    return spark.createDataFrame([(label, i, None if v is None else [None if x is None else float(x) for x in v], "clash", 7) for i, v, label in rows], VECTORS)


def cloud(seed, n, d, spread=0.15):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, d))
    x = centres[r.integers(0, 12, n)] + spread * r.normal(size=(n, d))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


UNUSABLE = [(900_001, None, 1), (900_002, [0.5, None, 0.5, 0.5] * 2, 1), (900_003, [float("nan")] * 8, 1), (900_004, [float("inf")] * 8, 1), (900_005, [], 1)]


# --- 11: codes ---------------------------------------------------------------------------


def plain_codes(rows, entries=256, rounds=4):
    ok = [r for r in rows if r[1] is not None and len(r[1]) and all(x is not None and np.isfinite(x) for x in r[1])]
    x = np.array([np.floor(1024 * np.array(v, np.float32).astype(float)) for _, v, _ in ok]).astype(np.int64)
    first = sorted(range(len(ok)), key=lambda i: (ok[i][0] is None, ok[i][0] or 0, list(np.float32(ok[i][1]))))[:entries]
    books = [p[first] for p in np.split(x, 4, axis=1)]
    for step in range(rounds + 1):
        near = []
        for j, p in enumerate(np.split(x, 4, axis=1)):
            d = ((p[:, None, :] - books[j][None]) ** 2).sum(2)
            near.append((d.argmin(1), d.min(1)))
            if step < rounds:
                books[j] = np.array([p[near[j][0] == e].sum(0) // max(1, (near[j][0] == e).sum()) if (near[j][0] == e).any() else books[j][e] for e in range(len(books[j]))])
    error = sum(n[1] for n in near)
    by = defaultdict(int)
    for (_, _, label), e in zip(ok, error):
        by[label] += int(e)
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(
        ((r[0], "".join(f"{n[0][i]:02x}" for n in near), int(error[i]), by[r[2]], digest) for i, r in enumerate(ok)), key=str
    )


@pytest.mark.parametrize("n", [1, 100, 3000])
def test_codes_equal_plain_k_means(spark, n):
    x = cloud(1, n, 8)
    rows = [(i * 3, x[i].tolist(), None if i % 7 == 0 else i % 3) for i in range(n)]
    rows += [rows[0]] * 5 + [(3, x[-1].tolist(), 1), (None, x[n // 2].tolist(), 2)] + [(10**6 + i, x[0].tolist(), 0) for i in range(n // 2)] + UNUSABLE
    got = vector_codes.code_table(vectors(spark, rows).repartition(3))
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_codes(rows)


def test_codes_of_nothing_and_refusals(spark):
    assert vector_codes.code_table(vectors(spark, [])).count() == 0
    assert vector_codes.code_table(vectors(spark, UNUSABLE)).count() == 0
    with pytest.raises(ValueError, match="one length"):
        vector_codes.code_table(vectors(spark, [(1, [1.0] * 8, 0), (2, [1.0] * 4, 0)]))
    with pytest.raises(ValueError, match="one length"):
        vector_codes.code_table(vectors(spark, [(1, [1.0] * 6, 0)]))
    with pytest.raises(ValueError, match="too large"):
        vector_codes.code_table(vectors(spark, [(1, [1e30] * 8, 0)]))


def test_decoded_codes_lie_as_far_as_their_error(spark):
    x = cloud(3, 600, 8)
    codes, books = vector_codes.compress(vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)]))
    for r in books.decode(codes).collect():
        whole = np.floor(1024 * x[r.vec_id].astype(float))
        assert ((whole - 1024 * np.array(r.decoded)) ** 2).sum() == r.error


def test_salted_labels_give_the_same_totals(spark, monkeypatch):
    rows = [(i, v.tolist(), i % 5 or None) for i, v in enumerate(cloud(4, 300, 8))]
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 1)
    assert sorted((tuple(r) for r in vector_codes.code_table(vectors(spark, rows)).collect()), key=str) == plain_codes(rows)


@pytest.mark.parametrize("k,bits", [(2, 4), (3, 3), (5, 2)])
def test_hilbert_keys_step_to_a_neighbour(k, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * k), -1).reshape(-1, k).astype(np.uint32)
    keys = vector_codes.hilbert_bits(cells, bits).astype(np.int64) @ (1 << np.arange(k * bits - 1, -1, -1))
    walk = cells[np.argsort(keys)].astype(int)
    assert sorted(keys) == list(range(len(cells))) and (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("scale", [50, 1 << 26])
def test_shortlists_lose_no_nearest_entry(scale):
    r = np.random.default_rng(5)
    points = r.integers(-scale, scale, (640, 4)).astype(np.int32)
    points = points[vector_codes.hilbert_order(points)]
    points[64:128] = points[64]
    entries = r.integers(-scale, scale, (40, 4))
    entries[7] = entries[3]
    starts = np.arange(0, 640, vector_codes.BLOCK)
    low, high = np.minimum.reduceat(points, starts), np.maximum.reduceat(points, starts)
    near, error, only = vector_codes.assign(points, low, high, entries, True)
    d = ((points[:, None, :].astype(object) - entries[None].astype(object)) ** 2).sum(2)
    assert near.tolist() == [row.tolist().index(min(row)) for row in d] and error.tolist() == [min(row) for row in d]
    assert only[1] >= 0 or (d[64] == d[64].min()).sum() > 1


# --- 12: divergence ----------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, source string, term string, p long"


def plain_divergence(rows, min_docs, top=50):
    docs = [(lang or "", source or "", [t.translate({i: i + 32 for i in range(65, 91)}) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t in df if df[t] >= min_docs)
        v, sources = len(kept), sorted({d[1] for d in own})

        def shares(some):
            c = Counter(t for d in some for t in d[2])
            n = sum(c[t] for t in kept)
            return c, {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * v) for t in kept}

        q = shares(own)[1]
        each = {s: shares([d for d in own if d[1] == s]) for s in sources}
        for s in sources:
            pair = sorted(((-sum(abs(each[s][1][t] - each[o][1][t]) for t in kept), o.encode()) for o in sources if o != s))
            term = sorted((q[t] - each[s][1][t], t.encode()) for t in kept if each[s][0][t] and each[s][1][t] > q[t])
            for part, found in (("pair", pair), ("term", term[:top])):
                out += [(lang, s, part, item.decode(), -f, i + 1) for i, (f, item) in enumerate(found)]
    return sorted(out)


def source_rows(seed=6, n=240):
    r = np.random.default_rng(seed)
    words = ["Alpha", "alpha", "beta", "été", "ÉTÉ", "x1y", "don't", "東京", "zeta", "ÅNG\x00str", " break", "q\x7fr", "[tag]", "😀", "mix\x85ed"]
    rows = []
    for i in range(n):
        lang, source = ["en", "fr", None, "lone"][i % 4], [None, "a", "b", "ß", "B"][int(r.integers(0, 5))] if i % 4 < 3 else "only"
        rows.append((" ".join(r.choice(words, int(r.integers(0, 30)), p=r.dirichlet(np.ones(len(words))))), lang, source))
    return rows + [(None, "en", "a"), ("", "en", "empty"), (None, None, None), ("rare words here", "de", "s"), (None, "de", "t"), ("long Term " * 60_000, "en", "a"), rows[0], rows[0]]


@pytest.mark.parametrize("cells,tile,groups,flush", [(1 << 19, 512, 50_000, 10**6), (6, 2, 1, 20)])
def test_divergence_equals_plain_counting(spark, monkeypatch, cells, tile, groups, flush):
    for name, value in (("CELLS", cells), ("TILE", tile), ("BROADCAST_GROUPS", groups), ("FLUSH", flush)):
        monkeypatch.setattr(source_divergence, name, value)
    rows = source_rows()
    docs = spark.createDataFrame([(None, *r, "clash", 1) for r in rows], DOCS).repartition(3)
    got = source_divergence.divergence(docs, min_docs=5, top=4)
    assert got.dtypes == [("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    assert sorted(tuple(r) for r in got.collect()) == plain_divergence(rows, 5, 4)


def test_divergence_of_nothing(spark):
    assert source_divergence.divergence(spark.createDataFrame([], DOCS)).count() == 0
    one = source_divergence.divergence(spark.createDataFrame([(1, "a b", "en", "s", "", 0), (2, None, "en", "t", "", 0)], DOCS)).collect()
    assert sorted((r.source, r.item, r.value) for r in one) == [("s", "t", 0), ("t", "s", 0)]


def test_counts_beyond_64_bits_times_the_whole(spark):
    big = spark.range(1).select(source_divergence._share(F.lit(10**14), F.lit(3 * 10**14), F.lit(1000).cast("long")).alias("p")).first().p
    assert big == 1 + 10**9 * (10**14 + 5) // (3 * 10**14 + 5000)


# --- 13: tree ----------------------------------------------------------------------------


def plain_neighbours(x, ids, k, every=20):
    """(query row -> [(vec_id, score)]) by plain sums."""
    out = {}
    for i, a in enumerate(ids):
        if a % every == 0:
            score = vector_tree.products(np.repeat(x[i : i + 1].astype(float), len(x), 0), x.astype(float))
            rank = sorted((j for j in range(len(x)) if j != i), key=lambda j: (-score[j], ids[j]))[:k]
            out[i] = [(ids[j], float(score[j])) for j in rank]
    return out


def test_tree_reaches_its_recall_and_scores_are_exact(spark):
    x = cloud(7, 8000, 24, 0.5)
    df = vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)]).repartition(6)
    index = vector_tree.build(df, leaf_rows=100)
    assert 80 <= index.tree.n_leaves <= 100 and sum(index.rows_of) == 8000 and index.rows.count() == 8000
    found, visits, recall = vector_tree.search(index, index.rows.filter("vec_id % 20 = 0"))
    assert 0.95 <= recall and visits < index.tree.n_leaves / 2
    true, met = plain_neighbours(x, list(range(8000)), 20), 0
    rows = defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        rows[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(rows) == set(true)
    for q, got in rows.items():
        assert [g[0] for g in got] == list(range(1, 21)) and q not in [g[1] for g in got]
        met += len({g[1] for g in got} & {t[0] for t in true[q]})
        assert [g[2] for g in got] == sorted((g[2] for g in got), reverse=True)
        assert all(g[2] == vector_tree.products(x[[q]].astype(float), x[[g[1]]].astype(float))[0] for g in got)
    assert met >= 0.9 * 20 * len(true)


def test_all_leaves_give_the_exact_neighbours_with_ties_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(vector_tree, "ROWS", 64)  # hot leaves are dealt to several tasks
    monkeypatch.setattr(vector_tree, "QUERIES", 8)
    x = np.concatenate([cloud(8, 300, 8), np.repeat(cloud(9, 1, 8), 300, 0), np.round(cloud(10, 200, 8), 1)])
    ids = [int(i) for i in np.random.default_rng(0).permutation(len(x))]
    ids[5] = ids[6] = 20  # rows that share an id
    rows = [(i, v.tolist(), 0) for i, v in zip(ids, x)] + UNUSABLE + [(60, [0.0] * 8, 0), (None, x[0].tolist(), 0)]
    index = vector_tree.build(vectors(spark, rows).repartition(3), leaf_rows=50)
    found, visits, recall = vector_tree.search(index, index.rows.filter("vec_id % 20 = 0"), target=1.0)
    got = defaultdict(list)
    for r in found.orderBy("rank").collect():
        got[r.query].append((r.vec_id, r.score))
    if visits == index.tree.n_leaves:
        assert sorted(got.values()) == sorted(plain_neighbours(x, ids, 20).values())
    monkeypatch.setattr(vector_tree, "calibrated", lambda tree, *_: (tree.n_leaves, 1.0))
    found = vector_tree.search(index, index.rows.filter("vec_id % 20 = 0"))[0]
    got = defaultdict(list)
    for r in found.orderBy("rank").collect():
        got[r.query].append((r.vec_id, r.score))
    assert sorted(got.values()) == sorted(plain_neighbours(x, ids, 20).values())


def test_few_rows_and_none(spark):
    assert vector_tree.nearest(vectors(spark, [])).count() == 0
    assert vector_tree.nearest(vectors(spark, UNUSABLE)).count() == 0
    assert vector_tree.nearest(vectors(spark, [(20, [1.0] * 8, 0)])).count() == 0
    few = vector_tree.nearest(vectors(spark, [(20, [1.0] * 8, 0), (3, [2.0] * 8, 0), (4, [-1.0] * 8, 0), (1, [2.0] * 8, 0)])).orderBy("rank").collect()
    assert [tuple(r) for r in few] == [(20, 1, 1, 16.0), (20, 2, 3, 16.0), (20, 3, 4, -8.0)]
    with pytest.raises(ValueError, match="components"):
        vector_tree.nearest(vectors(spark, [(20, [1.0] * 8, 0), (3, [2.0] * 4, 0)]))


def test_every_query_gets_k_rows_however_few_leaves_it_asks_for(spark):
    x = cloud(11, 600, 8)
    index = vector_tree.build(vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)]), leaf_rows=5)
    found = vector_tree.search(index, index.rows.filter("vec_id % 20 = 0"), target=0.01)[0]
    assert found.count() == 30 * 20
