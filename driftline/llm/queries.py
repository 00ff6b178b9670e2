"""Registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import circulant_minhash, convnet, crf_pii, host_rules, line_dedup, neighbour_vote, packing, qgram_filter
from . import quotation_links, separator_scan, source_divergence, vector_codes, vector_tree
from .common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return separator_scan.token_counts(table(spark, sf_dir, "documents")).select(
        "doc_id", "file_id", "doc_no", "start", "n_tokens", "complete"
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_dedup.line_counts(docs, line_dedup.similar_lines(docs))


def op3_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.quality_verdicts(table(spark, sf_dir, "documents"))


def op4_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf_pii.digest(crf_pii.find_pii(table(spark, sf_dir, "documents")))


def op5_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_qgram_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qgram_filter.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotation_links.link_quotes(table(spark, sf_dir, "conversations"))


def op9_convnet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convnet.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_neighbour_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_vote.vote(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_hilbert_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_table(table(spark, sf_dir, "embeddings"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence(table(spark, sf_dir, "documents"))


def op13_means_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_tree.nearest(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_line_dedup, op3_host_rules, op4_crf_pii, op5_circulant_minhash, op6_packing,
        op7_qgram_filter, op8_quotation_links, op9_convnet, op10_neighbour_vote, op11_hilbert_codes,
        op12_source_divergence, op13_means_tree,
    )
}
