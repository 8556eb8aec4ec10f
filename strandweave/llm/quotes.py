"""Chat formatting: quoted passages are linked to the messages they come from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.llm.common import ascii_lower, cut, stored

#: A line's quote marks: each > with the blanks around it is one level.  A repeated group would recurse once a mark.
MARKS = r"^(?:[ \t>]*>)?"


def lines_of(messages: DataFrame) -> DataFrame:
    """Adds ``lines``: the text's lines with their quote level, content and normalised content."""
    return messages.withColumn(
        "lines",
        F.transform(
            F.split(F.coalesce("text", F.lit("")), "\n"),
            lambda x: F.struct(
                F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 0), "[^>]", "")).alias("level"),
                F.regexp_replace(x, MARKS + "[ \t]?", "").alias("content"),
                F.trim(F.regexp_replace(ascii_lower(F.regexp_replace(x, MARKS, "")), r"[\x09-\x0D\x20]+", " ")).alias("plain"),
            ),
        ),
    )


#: A line of fewer words is a passage only with a neighbour, or if it is all that stands at its level.
LEAST_WORDS = 3
#: The passages of a level: its lines, each two that follow each other, and all of them as one.
_PASSAGES = f"""transform(array(transform(filter(lines, x -> x.level {{0}} and x.plain != ''), x -> x.plain)), p -> array_distinct(concat(
    filter(p, x -> size(split(x, ' ')) >= {LEAST_WORDS}),
    if(size(p) > 1, transform(sequence(0, size(p) - 2), i -> concat(p[i], '\\n', p[i + 1])), array()),
    array(array_join(p, ' ')))))[0]"""


def link(messages: DataFrame) -> DataFrame:
    """Links of quoting messages to the messages they quote: conv_id, turn, reply_to, passages.

    ``messages``: conv_id, turn, text.  Passages are lines of LEAST_WORDS
    words, pairs of lines that follow each other, so that a quoted block
    counts for more than its lines, and all of a level.  One comes from the first earlier
    message of its conversation that says it without a quote mark.  The reply
    is to the message with the longest matched passages of the lowest quote
    level, of equals the latest.  Messages without a conversation or turn link
    to nothing.
    """
    parsed = lines_of(messages.select("conv_id", "turn", "text").where("conv_id is not null and turn is not null"))
    hashed = [F.sha2("passage", 256).alias("digest"), F.length("passage").alias("chars")]
    quoted = (
        parsed.where(F.expr("exists(lines, x -> x.level > 0)"))
        .select("conv_id", "turn", "lines", F.explode(F.expr("array_distinct(transform(filter(lines, x -> x.level > 0), x -> x.level))")).alias("level"))
        .select("conv_id", "turn", "level", F.explode(F.expr(_PASSAGES.format("= level"))).alias("passage"))
        .where("passage != ''")
        .select("conv_id", "turn", "level", *hashed)
        .distinct()
    )
    quoted = stored(quoted, "quoted")
    said = (
        parsed.select(F.col("conv_id").alias("c"), F.col("turn").alias("origin"), F.explode(F.expr(_PASSAGES.format("= 0"))).alias("passage"))
        .where("passage != ''")
        .select("c", "origin", *hashed)
        .groupBy("c", F.col("digest").alias("d"))
        .agg(F.min("origin").alias("origin"))
        .join(quoted.select(F.col("conv_id").alias("qc"), F.col("digest").alias("qd")).distinct(), F.expr("c = qc and d = qd"), "left_semi")
    )
    # only what is quoted somewhere, and written first, so that a passage quoted often can be split in the join
    said = stored(said, "said")
    same = (F.col("conv_id") == F.col("c")) & (F.col("digest") == F.col("d")) & (F.col("origin") < F.col("turn"))
    best = F.struct(-F.col("level"), F.col("matched"), F.col("origin"))
    return (
        quoted.join(said, same)
        .groupBy("conv_id", "turn", "level", "origin")
        .agg(F.sum("chars").alias("matched"), F.count(F.lit(1)).alias("n"))
        .groupBy("conv_id", "turn")
        .agg(F.max_by("origin", best).alias("reply_to"), F.sum("n").alias("passages"))
    )


def threads(links: DataFrame) -> DataFrame:
    """Adds ``thread`` (the first message of the chain of replies) and ``depth`` by pointer jumping.

    The number of rounds is the logarithm of the longest chain; turns rise
    along it, so it ends.
    """
    at = cut(links.select("conv_id", "turn", "reply_to", "passages", F.col("reply_to").alias("thread"), F.lit(1).cast("long").alias("depth")))
    while True:
        up = at.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("thread").alias("up"), F.col("depth").alias("more"))
        step = at.join(up, (F.col("conv_id") == F.col("c")) & (F.col("thread") == F.col("t")), "left")
        if step.where("t is not null").isEmpty():
            return at
        at = cut(step.select("conv_id", "turn", "reply_to", "passages", F.coalesce("up", "thread").alias("thread"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")))


def build(messages: DataFrame) -> DataFrame:
    """Messages without their quotes, in reply order by (conv_id, thread, turn).

    One row per row of ``messages`` (conv_id, turn, role, text): conv_id,
    thread, turn, depth, reply_to, role, text, n_quoted_lines, n_linked.  A
    reply stands after what it replies to, since that has a lower turn.  Null
    text is empty; a message without a conversation or turn is a thread of its
    own.  Quoted text that comes from no message stays out, too.  Rows that
    repeat a conversation and turn have the same links; an empty table gives
    none; further columns stay out, whatever their names.
    """
    linked = threads(link(messages)).select(
        F.col("conv_id").alias("c"), F.col("turn").alias("t"), "reply_to", "thread", "depth", "passages"
    )
    own = F.expr("array_join(transform(filter(lines, x -> x.level = 0), x -> x.content), '\n')")
    return (
        lines_of(messages.select("conv_id", "turn", "role", "text"))
        .select("conv_id", "turn", "role", own.alias("text"), F.expr("cast(size(filter(lines, x -> x.level > 0)) as bigint)").alias("n_quoted_lines"))
        .join(linked, (F.col("conv_id") == F.col("c")) & (F.col("turn") == F.col("t")), "left")
        .select("conv_id", F.coalesce("thread", "turn").alias("thread"), "turn", F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), "reply_to", "role", F.trim("text").alias("text"), "n_quoted_lines", F.coalesce("passages", F.lit(0)).cast("long").alias("n_linked"))
    )
