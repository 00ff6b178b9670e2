"""The corpus pipeline against a brute-force version of its stages."""

import corpus_pipeline
from tests.llm.test_operators import brute_components, brute_edits, brute_lines, brute_measures, encoded, frame, prose
from driftline.llm import circulant_minhash, qgram_filter
from driftline.llm.common import stored, table
from pyspark.sql import functions as F


def test_every_stage_takes_effect(spark, tmp_path):
    item = prose(900, 30, 5000)
    texts = [prose(700 + i, 60, 3000) for i in range(12)]
    texts += [texts[0], texts[1] + " more", "# $ " * 30, None, texts[2] + "\n" + prose(800, 40, 3000), prose(801, 30, 3000) + " " + item]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    frame(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    kept = {}
    for i, t in enumerate(texts):
        words, chars, symbols, dup, repeat = brute_measures(t)
        if words >= 10 and 100 * repeat <= 20 * words and symbols <= 0.3 * words:
            kept[i] = t
    ids = sorted(kept)
    stay = brute_lines([kept[i] for i in ids])
    texts2 = {i: "\n".join(x for n, x in enumerate(kept[i].split("\n")) if (k, n) in stay) for k, i in enumerate(ids)}
    texts2 = {i: t for i, t in texts2.items() if t}
    ids = sorted(texts2)
    label, _ = brute_components([texts2[i] for i in ids], width=5)
    ids = [i for k, i in enumerate(ids) if label[k] == k]
    f = qgram_filter.fold(item)
    ids = [i for i in ids if brute_edits(f, qgram_filter.fold(texts2[i])) > qgram_filter.budget_of(len(f), qgram_filter.ERROR_RATIO)]
    want = {i: len(encoded([texts2[i]])[0]) + 1 for i in ids}
    assert {r.doc_id: r.doc_tokens for r in got} == want
    assert 12 not in want and 13 not in want and 14 not in want and 15 not in want and 17 not in want and 16 in want


def test_rows_are_judged_by_their_own_text_whatever_their_id(spark, tmp_path):
    item = prose(900, 30, 5000)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    good, other, copied = prose(1, 60, 3000), prose(2, 60, 3000), prose(3, 60, 3000)
    rows = [(1, good), (1, "$ # " * 20), (2, other), (2, other + " " + item), (None, "# # " * 9), (None, copied), (None, item), (7, copied), (8, copied)]
    docs = spark.createDataFrame([(i, t, "en", "h", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("host", F.lit("clash")).withColumn("rep", F.lit(1))
    texts = lambda df: sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in df.collect())
    one = corpus_pipeline.quality_rules(spark, docs, str(tmp_path))
    assert one.columns == docs.columns
    assert texts(one) == sorted((i is None, i or 0, t) for i, t in rows if not t.startswith(("$", "#")))
    three = corpus_pipeline.near_copies(spark, one, str(tmp_path))
    assert three.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in three.filter(F.col("text") == copied).collect()) == [7]  # a row with an id first
    four = corpus_pipeline.benchmark_leaks(spark, three, str(tmp_path))
    assert four.columns == docs.columns
    assert texts(four) == [(False, 1, good), (False, 2, other), (False, 7, copied)]
    for stage in (corpus_pipeline.quality_rules, corpus_pipeline.repeated_lines, corpus_pipeline.near_copies, corpus_pipeline.benchmark_leaks, corpus_pipeline.packed):
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_near_copies_are_gone_after_the_pipeline(spark):
    sf = "/root/testdata/sf0.01"
    rows = stored(corpus_pipeline.quality_rules(spark, table(spark, sf, "documents"), sf), "q")
    copies = {r.doc_id for r in circulant_minhash.near_duplicates(rows, width=5).filter("not kept").collect()}
    left = corpus_pipeline.near_copies(spark, stored(corpus_pipeline.repeated_lines(spark, rows, sf), "l"), sf)
    ids = {r.doc_id for r in left.select("doc_id").collect()}
    assert len(copies) > 50 and len(copies - ids) >= 0.9 * len(copies)
    assert len(ids) > 0.85 * (rows.count() - len(copies))  # the rest stays
