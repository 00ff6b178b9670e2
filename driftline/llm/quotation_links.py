"""Reply-ordered conversations: nested quotes parsed, hashed and linked to the messages they quote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

#: A line's quote marks, possibly with spaces between them.
QUOTE = r"^[ \t]*((?:>[ \t]?)+)"

#: Successive words by which passages are matched.
RUN = 5
#: Turns of a conversation that one lookup of the last message with a hash spans.
BLOCK_TURNS = 1024
#: What names a passage.
PASSAGE = ["conv_id", "turn", "message", "depth", "passage"]


def quote_depth(line: Column) -> Column:
    """How many ``>`` marks stand before the line's text."""
    marks = F.regexp_extract(line, QUOTE, 1)
    return F.length(F.regexp_replace(marks, "[^>]", ""))


def normalised(line: Column) -> Column:
    """A line without quote marks, in lower case, runs of other than letters and digits as one space."""
    bare = F.regexp_replace(line, QUOTE, "")
    return F.trim(F.regexp_replace(F.lower(bare), r"[^\p{L}\p{N}]+", " "))


def message_lines(messages: DataFrame) -> DataFrame:
    """The messages' columns but text, with line_no, depth, plain, and passage: successive lines of one depth."""
    kept = [c for c in messages.columns if c != "text"]
    lines = messages.select(*kept, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.select(*kept, "line_no", quote_depth(F.col("line")).alias("depth"), normalised(F.col("line")).alias("plain"))
    alike = W.partitionBy("conv_id", "turn", "message", "depth").orderBy("line_no")
    return lines.withColumn("passage", F.col("line_no") - F.row_number().over(alike))


def passage_runs(lines: DataFrame) -> DataFrame:
    """PASSAGE, copies, hash and the numbers of the lines (at) of what a passage is matched by.

    That is every RUN successive words, across line ends, every whole line, and a
    passage of fewer words as one.
    """
    some = lines.filter("plain != ''").groupBy(*PASSAGE, "copies").agg(
        F.sort_array(F.collect_list(F.struct("line_no", "plain"))).alias("lines")
    )
    word = lambda x: F.transform(F.split(x["plain"], " "), lambda w: F.struct(x["line_no"].alias("line_no"), w.alias("word")))
    some = some.withColumn("words", F.flatten(F.transform("lines", word)))
    n = F.size("words")

    def run(begin: Column) -> Column:
        part = F.slice("words", begin, RUN)
        return F.struct(F.xxhash64(F.concat_ws(" ", part["word"])).alias("hash"), F.array_distinct(part["line_no"]).alias("at"))

    whole = lambda x: F.struct(F.xxhash64(x["plain"]).alias("hash"), F.array(x["line_no"]).alias("at"))
    runs = F.array_union(F.transform("lines", whole), F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), n - RUN + 1)), run))
    return some.select(*PASSAGE, "copies", F.inline(runs))


def _earlier_own(quoted: DataFrame, own: DataFrame) -> DataFrame:
    """conv_id, hash, turn, origin: of each quoted hash the first message and the last one before turn that have it as their own.

    The last one is looked up in blocks of turns and over the blocks, so no task sorts
    all turns of a hash.
    """
    asked = quoted.select("conv_id", "hash", "turn").distinct()
    own = own.join(asked.select("conv_id", "hash").distinct(), ["conv_id", "hash"], "left_semi")
    first = asked.join(own.groupBy("conv_id", "hash").agg(F.min("turn").alias("origin")), ["conv_id", "hash"])
    both = own.withColumn("own", F.col("turn")).unionByName(asked.withColumn("own", F.lit(None).cast("long")))
    both = both.withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS))
    inside = W.partitionBy("conv_id", "hash", "block").orderBy("turn").rangeBetween(W.unboundedPreceding, -1)
    over = W.partitionBy("conv_id", "hash").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = both.groupBy("conv_id", "hash", "block").agg(F.max("own").alias("own"))
    blocks = blocks.select("conv_id", "hash", "block", F.max("own").over(over).alias("before"))
    last = (
        both.withColumn("last", F.max("own").over(inside)).filter("own is null")
        .join(blocks, ["conv_id", "hash", "block"])
        .select("conv_id", "hash", "turn", F.coalesce("last", "before").alias("origin"))
    )
    return first.select("conv_id", "hash", "turn", "origin").unionByName(last).filter("origin < turn").distinct()


def link_quotes(
    messages: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row for each message: conv_id, turn, role, parent_turn, root_turn, depth, n_quoted, n_linked, text.

    Quote levels are the ``>`` marks before a line. Successive quoted lines of one
    level are a passage, which is hashed without marks, case, punctuation and line
    ends: every RUN successive words, and every whole line. So a quote that was
    wrapped anew or holds a part of a longer line finds its source; a part of fewer
    than RUN words does so only where it is a whole line or passage there. Of each hash the first
    message of the conversation and the last one before the quote that have it as
    their own are asked how much of the passage they hold. Of the messages that a
    reply quotes at its outermost level the one with most lines is its parent, among
    equals the one with most hashes, then the latest. Deeper levels count as links
    only. text is the message without its quotes and without the lines that introduce
    them (ending in a colon just before a quote). root_turn and depth follow the
    parents; ordering by conv_id, root_turn, turn gives every reply after what it answers.

    A hash of a quote has two candidates at most, so a line that everyone uses makes no
    product. Only conversations with a quote are searched. Parents are followed
    by pointer doubling, in rounds that grow with the logarithm of the longest chain.

    Nulls: a null text is empty; a message without conv_id or turn links with nothing
    and stands as its own root; rows that repeat conv_id and turn count as one
    message for linking and stay in the result each. An empty table gives no rows.
    """
    base = messages.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.col(f"`{role_col}`").alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    whole = base.filter("conv_id is not null and turn is not null").select("conv_id", "turn", "text")
    # conversations with a quote; a large one is dealt out by its turns
    deal = F.pmod("turn", F.lit(64)).cast("int").alias("deal")
    threads = whole.filter(F.col("text").rlike("(?m)" + QUOTE)).select("conv_id").distinct()
    threads = threads.select("conv_id", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("deal"))
    live = whole.select("*", deal).join(threads, ["conv_id", "deal"], "left_semi")
    live = live.groupBy("conv_id", "turn", "text").agg(F.count("*").alias("copies"))
    lines = stored(message_lines(live.withColumn("message", F.xxhash64("text"))), "lines")
    runs = stored(passage_runs(lines), "runs")
    own = runs.filter("depth = 0").select("conv_id", "turn", "hash").distinct()
    quoted = runs.filter("depth > 0")
    asked = quoted.join(_earlier_own(quoted, own), ["conv_id", "hash", "turn"]).select(*PASSAGE, "origin").distinct()
    held = quoted.join(asked, PASSAGE).join(own.withColumnRenamed("turn", "origin"), ["conv_id", "origin", "hash"])
    linked = held.select(*PASSAGE, "copies", "origin", F.explode("at").alias("line_no")).groupBy(
        "conv_id", "turn", "message", "copies", "depth", "line_no", "origin"
    ).agg(F.count("*").alias("n"))
    votes = linked.filter("depth = 1").groupBy("conv_id", "turn", "origin").agg(
        F.sum("copies").alias("lines"), F.sum(F.col("copies") * F.col("n")).alias("hashes")
    )
    parents = votes.groupBy("conv_id", "turn").agg(F.max_by("origin", F.struct("lines", "hashes", "origin")).alias("parent_turn"))
    n_linked = linked.select("conv_id", "turn", "message", "copies", "line_no").distinct().groupBy("conv_id", "turn").agg(
        F.sum("copies").alias("n_linked")
    )
    reply = (
        lines.filter("depth > 0 and plain != ''").groupBy("conv_id", "turn").agg(F.sum("copies").alias("n_quoted"))
        .join(n_linked, ["conv_id", "turn"], "left").join(parents, ["conv_id", "turn"], "left")
    )
    reply = stored(reply, "replies")
    # pointer doubling over the messages that have a parent
    hop = reply.filter("parent_turn is not null").select(
        "conv_id", "turn", F.col("parent_turn").alias("up"), F.lit(1).cast("long").alias("steps")
    )
    hop = stored(hop, "hops")
    moving = not hop.isEmpty()
    while moving:
        further = hop.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("steps").alias("more"))
        step = stored(
            hop.join(further, ["conv_id", "up"], "left").select(
                "conv_id", "turn", F.coalesce("next", "up").alias("up"),
                (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "hops",
        )
        moving = not step.filter("moved").isEmpty()
        hop = step.drop("moved")
    roots = hop.select("conv_id", "turn", F.col("up").alias("root_turn"), F.col("steps").alias("depth"))
    return (
        base.join(reply, ["conv_id", "turn"], "left")
        .join(roots, ["conv_id", "turn"], "left")
        .select(
            "conv_id", "turn", "role", "parent_turn",
            F.coalesce("root_turn", "turn").alias("root_turn"),
            F.coalesce("depth", F.lit(0)).alias("depth"),
            F.coalesce("n_quoted", F.lit(0)).alias("n_quoted"),
            F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
            unquoted(F.col("text")).alias("text"),
        )
    )


def unquoted(text: Column) -> Column:
    """The text without quoted lines and without lines ending in a colon just before them."""
    marked = F.split(text, "\n")
    quoted = lambda x: x.rlike(QUOTE)
    kept = F.filter(
        marked,
        lambda x, i: ~quoted(x) & ~(x.rlike(r":\s*$") & F.coalesce(quoted(F.get(marked, i + 1)), F.lit(False))),
    )
    return F.when(text.rlike("(?m)" + QUOTE), F.regexp_replace(F.array_join(kept, "\n"), r"^[ \t\n]+|[ \t\n]+$", "")).otherwise(text)
