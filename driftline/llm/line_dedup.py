"""Line dedup as an exact set-similarity join, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, id_and_text, stored

#: Jaccard similarity in percent from which a later line goes.
PERCENT = 90
#: Buckets of the token counts that rank tokens by rarity, a power of two; the table of ranks is this long at any size.
BUCKETS = 1 << 16
#: Documents with lines to verify, of some 80 bytes each, up to which they are broadcast to the texts.
BROADCAST_DOCS = 250_000
_LOW = 56
#: A line's place: the document, which of the texts under its id, and the line's number.
PLACE = ["doc_id", "version", "line_no"]
_BLANK = " \t\x0b\f\r"


def _plain(text: Column) -> Column:
    """Lower case with blanks for all white space but line ends, so that single characters cut it without patterns."""
    text = F.lower(text)
    for space in "\t\x0b\f\r":
        text = F.replace(text, F.lit(space), F.lit(" "))
    return text


def _words(line: Column) -> Column:
    """Words of a plain line, in order of appearance."""
    return F.array_remove(F.split(line, " "), "")


def line_tokens(line: Column) -> Column:
    """Distinct lower-case words of a line, in order of appearance."""
    return F.array_distinct(_words(_plain(line)))


def _versioned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and version, which tells the texts under one id apart."""
    return id_and_text(docs, id_col, text_col).withColumn("version", F.xxhash64("text"))


def _lines(base: DataFrame) -> DataFrame:
    """PLACE and the plain line, of the lines that hold more than blanks."""
    lines = base.select("doc_id", "version", F.posexplode(F.split(_plain(F.col("text")), "\n")).alias("line_no", "line"))
    return lines.filter("trim(line) != ''")


def _numbers(line: Column, number) -> Column:
    """Sorted distinct ``number`` of the words of a plain line."""
    numbers = F.array_remove(F.transform(F.split(line, " "), number), number(F.lit("")))
    return F.sort_array(F.array_distinct(numbers))


def _ranks(base: DataFrame, buckets: int) -> Column:
    """For each bucket of tokens a rank from 0 to 127 that grows with the logarithm of its count.

    All words of all texts are counted. What comes to the driver is one number for
    each bucket, a fixed size; it goes out again as a literal.
    """
    words = F.split(F.replace(_plain(F.col("text")), F.lit("\n"), F.lit(" ")), " ")
    counts = (
        base.select(F.explode(words).alias("token"))
        .groupBy(_bucket(F.xxhash64("token"), buckets).alias("bucket"))
        .count()
        .select("bucket", F.least(F.lit(127), F.floor(F.log2("count") * 4)).cast("int").alias("rank"))
        .collect()
    )
    ranks = [0] * buckets
    for r in counts:
        ranks[r["bucket"]] = r["rank"]
    return F.split(F.lit(",".join(map(str, ranks))), ",").cast("array<long>")


def _bucket(h: Column, buckets: int) -> Column:
    return h.bitwiseAND(F.lit(buckets - 1)).cast("int")


def _by_rarity(ranks: Column, buckets: int):
    """A token as a number that sorts by rarity: rank above, low bits of its fingerprint below."""

    def number(token: Column) -> Column:
        h = F.xxhash64(token)
        rank = F.coalesce(F.get(ranks, _bucket(h, buckets)), F.lit(0).cast("long"))  # never null, so arrays sort as plain numbers
        return F.shiftleft(rank, _LOW).bitwiseOR(h.bitwiseAND(F.lit((1 << _LOW) - 1)))

    return number


#: What an entry of a bucket holds of its set, in the order by which a bucket's first set is chosen.
_ENTRY = (*PLACE, "n", "pos", "parity")


def similar_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, buckets: int = BUCKETS
) -> DataFrame:
    """doc_id, version, line_no of every line that stays although others may match it.

    Lines are token sets. A line goes if an earlier one, by PLACE, has
    ``100 * intersection >= percent * union``. Equal sets, by 128 bits of their tokens,
    collapse to their first place, which names the set from then on. Tokens are ordered
    by rarity, and sets meet on the tokens of their prefixes, under the length filter, the positional filter and a bound from 64-bit
    parity maps (each differing token changes one bit at most); what is left is
    verified on the whole sets. Sets so small that only equal ones match have no
    prefix. A set first meets the earliest set of each of its buckets, which settles
    most of a large group of near copies without pairs inside it; only sets not
    settled so meet the others. Lines without a token are
    not listed.

    Nulls: rows without an id match nothing and are not listed; a null text has no
    tokens. Rows that repeat id and text share their places; other texts under one
    id are told apart by version, a hash of the text, and come in its order.
    """
    base = _versioned(docs, id_col, text_col).filter("doc_id is not null")
    n = F.col("n")
    tokens = _numbers(F.col("line"), _by_rarity(_ranks(base, buckets), buckets))
    probe = n - F.ceil(n * percent / 100).cast("int") + 1
    matchable = n * (100 - percent) >= percent  # below, no other set is similar enough
    sets = (
        _lines(base).select(*PLACE, tokens.alias("tokens")).withColumn("n", F.size("tokens"))
        .select(
            F.struct(*PLACE).alias("at"), "n", F.xxhash64("tokens").alias("set_a"), F.xxhash64(F.lit(1), "tokens").alias("set_b"),
            F.when(matchable, F.slice("tokens", 1, probe)).alias("prefix"), F.when(matchable, _parity(F.col("tokens"))).alias("parity"),
        )
        .groupBy("set_a", "set_b", "n", "prefix", "parity")
        .agg(F.min("at").alias("at"))
        .select("at.*", "n", "prefix", "parity")
    )
    sets = stored(sets, "sets")
    entries = _entries(sets)
    # a set is settled by the first set of a bucket where it can; pairs in number are the prefixes at most
    pivots = entries.groupBy("token").agg(F.min(F.struct(*_ENTRY)).alias("e"), F.count("*").alias("size"))
    pivots = pivots.filter("size > 1").select("token", *(F.col(f"e.{c}").alias(f"e_{c}") for c in _ENTRY))
    settled = _later_of(entries.join(pivots, "token"), base, percent)
    # what is left meets every earlier set of its buckets
    earlier = entries.select("token", *(F.col(c).alias(f"e_{c}") for c in _ENTRY))
    rest = _entries(sets.join(settled, PLACE, "left_anti"))
    more = _later_of(rest.join(earlier, "token"), base, percent)
    staying = stored(sets.select(*PLACE).join(settled.union(more), PLACE, "left_anti"), "staying")
    discard(sets, settled, more)
    return staying


def _entries(sets: DataFrame) -> DataFrame:
    return sets.select(*PLACE, "n", "parity", F.posexplode("prefix").alias("pos", "token"))


def _later() -> Column:
    """Whether a set's place comes after the other's, compared number by number, as structs of a pair cost more."""
    doc, version, line = ((F.col(c) > F.col(f"e_{c}"), F.col(c) == F.col(f"e_{c}")) for c in PLACE)
    return doc[0] | (doc[1] & (version[0] | (version[1] & line[0])))


def _later_of(pairs: DataFrame, base: DataFrame, percent: int) -> DataFrame:
    """The places of the sets of those pairs (a set and an earlier one, e_) that are similar; filtered first, then verified whole."""
    n, m = F.col("n"), F.col("e_n")
    asked = F.ceil((n + m) * F.lit(percent) / F.lit(100.0 + percent) - 1e-9)  # shared tokens
    other = [f"e_{c}" for c in PLACE]
    candidates = (
        pairs.filter(_later())
        .filter((F.least(n, m) * 100 >= F.greatest(n, m) * percent))
        .filter(1 + F.least(n - F.col("pos") - 1, m - F.col("e_pos") - 1) >= asked)
        .filter(F.bit_count(F.col("parity").bitwiseXOR(F.col("e_parity"))) <= n + m - 2 * asked)
        .select(*PLACE, *other)
        .distinct()
    )
    candidates = stored(candidates, "pairs")
    # whole sets again, of the wanted lines only, which are fetched with their document
    both_ends = F.array(F.struct(*PLACE), F.struct(*(F.col(o).alias(c) for o, c in zip(other, PLACE, strict=True))))
    wanted = candidates.select(F.inline(both_ends)).groupBy("doc_id", "version").agg(F.sort_array(F.collect_set("line_no")).alias("numbers"))
    wanted = stored(wanted.withColumn("chosen", _chosen(F.col("numbers"))), "wanted")
    few = wanted.count() <= BROADCAST_DOCS  # else the texts are shuffled to them
    lines = F.filter(F.split(_plain(F.col("text")), "\n"), lambda x, i: F.coalesce(F.get("chosen", i), F.lit(False)))
    found = base.join(F.broadcast(wanted) if few else wanted, ["doc_id", "version"]).select(
        "doc_id", "version", F.inline(F.arrays_zip(F.col("numbers").alias("line_no"), lines.alias("line")))
    )
    whole = found.select(*PLACE, _numbers(F.col("line"), lambda t: F.xxhash64(t)).alias("tokens")).dropDuplicates(PLACE)
    whole = stored(whole, "whole")
    both = F.size(F.array_intersect("tokens", "e_tokens"))
    later = stored(
        candidates.join(whole, PLACE)
        .join(whole.select(*(F.col(c).alias(o) for o, c in zip(other, PLACE, strict=True)), F.col("tokens").alias("e_tokens")), other)
        .withColumn("both", both)
        .filter(F.col("both") * 100 >= percent * (F.size("tokens") + F.size("e_tokens") - F.col("both")))
        .select(*PLACE)
        .distinct(),
        "settled",
    )
    discard(candidates, wanted, whole)
    return later


def _chosen(numbers: Column) -> Column:
    """An array that is true at each of the sorted numbers, so that a line is looked up in one step."""
    before = F.concat(F.array(F.lit(-1)), numbers)
    gaps = F.zip_with(numbers, F.slice(before, 1, F.size(numbers)), lambda b, a: F.concat(F.array_repeat(F.lit(False), b - a - 1), F.array(F.lit(True))))
    return F.flatten(gaps)


def _parity(tokens: Column) -> Column:
    return F.aggregate(
        tokens, F.lit(0).cast("long"), lambda acc, t: acc.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(F.lit(63)).cast("int")))
    )


def _has_token(line: Column) -> Column:
    return F.btrim(line, F.lit(_BLANK)) != ""


def line_counts(docs: DataFrame, staying: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_token_lines, n_removed for each row, from the lines that stay.

    Nulls: a null text is one empty line; a row without an id loses nothing. Rows that
    repeat id and text have equal counts; another text under the same id has its
    own. An empty table gives no rows. Only the two named columns are read.
    """
    kept = staying.groupBy("doc_id", "version").agg(F.count("*").alias("n_staying"))
    lines = F.split("text", "\n")
    counted = _versioned(docs, id_col, text_col).select(
        "doc_id", "version",
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.filter(lines, _has_token)).cast("long").alias("n_token_lines"),
    )
    return counted.join(kept, ["doc_id", "version"], "left").select(
        "doc_id", "n_lines", "n_token_lines",
        F.when(F.col("doc_id").isNull(), F.lit(0).cast("long"))
        .otherwise(F.col("n_token_lines") - F.coalesce("n_staying", F.lit(0))).alias("n_removed"),
    )


def without_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, buckets: int = BUCKETS
) -> DataFrame:
    """``docs`` with later matching lines taken out of the text; all columns stay.

    A document that had tokens and keeps no line with a token goes. Lines without a
    token stay where others do.

    Nulls: a null text stays null; rows without an id are passed through untouched
    and match nothing. Rows that repeat id and text keep the same lines; another text
    under the same id is a document of its own. An empty table gives no rows. Columns
    of other names pass unchanged, those that begin with ``__line_`` are not allowed.
    """
    staying = similar_lines(docs, id_col, text_col, percent, buckets)
    kept = staying.groupBy(F.col("doc_id").alias("__line_id"), F.col("version").alias("__line_version")).agg(
        _chosen(F.sort_array(F.collect_set("line_no"))).alias("__line_staying")
    )
    text = F.col(f"`{text_col}`")
    left = F.array_join(
        F.filter(F.split(text, "\n"), lambda x, i: ~_has_token(x) | F.coalesce(F.get("__line_staying", i), F.lit(False))), "\n"
    )
    joined = docs.join(
        kept,
        (F.col(f"`{id_col}`").cast("long") == F.col("__line_id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("__line_version")),
        "left",
    )
    untouched = F.col(f"`{id_col}`").isNull() | text.isNull() | ~text.rlike(r"[^ \t\n\x0B\f\r]")
    new = F.when(untouched, text).otherwise(left)
    kept_rows = joined.filter(untouched | F.col("__line_id").isNotNull()).withColumn("__line_left", new)
    return kept_rows.select(*(F.col("__line_left").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns))
