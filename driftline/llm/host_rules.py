"""Quality rules for each document, with failures pooled by host under an empirical beta prior."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
#: Soft rules: symbols per word, share of repeated lines, bounds of the mean word length.
SYMBOLS_PER_WORD = 0.3
DUP_LINE_SHARE = 0.5
MEAN_WORD = (2.5, 12.0)
#: A host is distrusted from this shrunken rate of failing documents on.
HOST_RATE = 0.5
#: Hosts, of some 60 bytes each, up to which their table is broadcast.
BROADCAST_HOSTS = 100_000

_SYMBOLS = "#*$%&|<>"
_WHITE = " \t\n\x0b\x0c\r"
_DROP_SYMBOLS = str.maketrans("", "", _SYMBOLS)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a ``window``-word run found twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    # numbers of runs, doubled and extended until they stand for whole windows; always exact
    runs, have = ids, 1
    while have < window:
        step = min(have, window - have)
        m = len(ids) - have - step + 1
        key = runs[:m] * (int(runs.max()) + 1) + runs[step : step + m]
        have += step
        if have < window:
            runs = np.unique(key, return_inverse=True)[1]
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(twice), 1)
    np.add.at(cover, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def measures(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at ASCII white space only
    white = sum(map(text.count, _WHITE))
    seen: set[str] = set()
    dup = 0
    if "\n" in text:
        for line in text.split("\n"):
            if line.strip(_WHITE):
                if line in seen:
                    dup += 1
                seen.add(line)
    symbols = sum(map(text.count, _SYMBOLS))
    return len(words), len(text) - white, symbols, dup, repeated_words(words)


_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measured(text: Column) -> Column:
    """A struct of n_lines and the measures of a text; null is empty."""

    @F.pandas_udf(", ".join(f"{n} long" for n in ("n_lines", *_MEASURES)))
    def run(texts: pd.Series) -> pd.DataFrame:
        texts = texts.fillna("")
        out = pd.DataFrame([measures(t) for t in texts], columns=_MEASURES)
        out.insert(0, "n_lines", texts.str.count("\n").to_numpy() + 1)
        return out.astype("int64")

    return run(text)


def _failures() -> list[Column]:
    mean = F.try_divide(F.col("word_chars"), F.col("n_words"))
    soft = (
        (F.col("n_symbols") > SYMBOLS_PER_WORD * F.col("n_words"))
        | (F.col("n_dup_lines") > DUP_LINE_SHARE * F.col("n_lines"))
        | F.coalesce(~mean.between(*MEAN_WORD), F.lit(False))
    )
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return [base.alias("base_failed"), soft.alias("soft_failed")]


def document_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Measures and rule failures of each row: doc_id, host, counts, base_failed, soft_failed."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{host_col}`").cast("string").alias("host"),
        _measured(F.col(f"`{text_col}`")).alias("m"),
    ).select("doc_id", "host", "m.*").select("*", *_failures())


def host_verdicts(rules: DataFrame, rate: float = HOST_RATE) -> DataFrame:
    """host, n_docs, n_failed, shrunk_rate, distrusted: one row for each host that has a name.

    Failures are counted with map-side sums, so a host with a third of all rows costs
    no more than another. The prior is Beta(a, b) fitted by moments to the hosts'
    rates, each host weighing as one. Where noise explains all spread, or there is one
    host, the prior lies at the pooled rate and weighs as much as all rows; where the
    spread is more than a beta has, it weighs 2.
    The shrunken rate is ``(n_failed + a) / (n_docs + a + b)``.
    """
    failed = (F.col("base_failed") | F.col("soft_failed")).cast("long")
    hosts = (
        rules.filter("host is not null")
        .groupBy("host")
        .agg(F.count("*").alias("n_docs"), F.sum(failed).alias("n_failed"))
    )
    share = F.col("n_failed") / F.col("n_docs")
    prior = hosts.agg(
        F.avg(share).alias("m"),
        F.var_samp(share).alias("v"),
        F.avg(share * (1 - share) / F.col("n_docs")).alias("noise"),
        (F.sum("n_failed") / F.sum("n_docs")).alias("pooled"),
        F.sum("n_docs").cast("double").alias("rows"),
    )
    spread = F.col("v") - F.col("noise")  # what binomial noise does not explain
    total = F.col("m") * (1 - F.col("m")) / F.when(spread > 1e-12, spread) - 1
    size = F.when(total > 0, total).when(total <= 0, F.lit(2.0)).otherwise(F.col("rows"))
    centre = F.when(total > 0, F.col("m")).otherwise(F.col("pooled"))
    a, ab = prior.select((centre * size).alias("a"), size.alias("ab")).first()  # two numbers
    if a is None:
        a, ab = 1.0, 2.0
    return (
        hosts.withColumn("shrunk_rate", (F.col("n_failed") + F.lit(a)) / (F.col("n_docs") + F.lit(ab)))
        .withColumn("distrusted", F.col("shrunk_rate") >= rate)
        .select("host", "n_docs", "n_failed", "shrunk_rate", "distrusted")
    )


def quality_verdicts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", rate: float = HOST_RATE
) -> DataFrame:
    """One row for each document: measures, base_failed, host figures and kept.

    A document goes if it fails a base rule or a soft rule of its own, or if its
    host is distrusted and it offends in some measure at all (a symbol, a repeated
    line or a repeated run of words): a host's record lowers what is tolerated and
    never condemns a spotless document.

    Nulls: a null text has no words and fails; a row without a host is judged alone,
    one without an id like any other.
    Rows that repeat are judged each. An empty table gives no rows. Only the three
    named columns are read. Up to BROADCAST_HOSTS hosts meet the documents by
    broadcast; beyond, Spark chooses the join and splits a hot host.
    """
    rules = stored(document_rules(docs, id_col, text_col, host_col), "rules")
    judged = _judged(rules, host_verdicts(rules, rate))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "host", "n_docs", "n_failed", F.round("shrunk_rate", 6).alias("shrunk_rate"), "soft_failed",
    )


def _judged(rules: DataFrame, hosts: DataFrame) -> DataFrame:
    """``rules`` with the figures of each row's host and kept."""
    hosts = stored(hosts, "hosts")
    if hosts.count() <= BROADCAST_HOSTS:
        hosts = F.broadcast(hosts)
    offends = (F.col("n_symbols") > 0) | (F.col("n_dup_lines") > 0) | (F.col("n_repeat_words") > 0)
    distrusted = F.coalesce("distrusted", F.lit(False))
    return rules.join(hosts, "host", "left").withColumn(
        "kept", ~(F.col("base_failed") | F.col("soft_failed") | (distrusted & offends))
    )


def without_rejected(
    docs: DataFrame, text_col: str = "text", host_col: str = "source", rate: float = HOST_RATE
) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_verdicts` keeps, with all their columns.

    The measures are stored beside each row, so every row is judged by its own text and
    host whatever its id: rows without an id, and rows that repeat one, are judged each.
    A null text goes. An empty table gives no rows. Column names that begin
    with ``__quality`` are not allowed.
    """
    rows = docs.select("*", _measured(F.col(f"`{text_col}`")).alias("__quality"))
    rows = stored(rows, "measured")
    host = F.col(f"`{host_col}`").cast("string").alias("host")
    rules = rows.select(host, "__quality.*").select("*", *_failures())
    whole = rows.select(host, "__quality.*", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__quality_row"))
    judged = _judged(whole.select("*", *_failures()), host_verdicts(rules, rate))
    return judged.filter("kept").select("__quality_row.*")
