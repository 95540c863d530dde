"""Chat formatting: conversations as one marked-up text each, and one example per assistant reply.

A conversation is formatted once. Every assistant turn then becomes an example
of its own: the text up to the end of that reply, of which only the reply is
trainable. Examples are cut from the one formatted text, so a conversation is
gathered once, by one shuffle on its id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapakdw.llm.text import let

# The marks of the template, and the control strings of public
# chat templates that must not appear inside a text.
TURN, HEADER_END, TURN_END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROLS = r"<(?=/?s>|\|(?:im_start|im_sep|im_end|endoftext)\|>|<SYS>>|</SYS>>)|\[(?=/?INST\])"
ESCAPE = "\\"


def escape(text: Column) -> Column:
    """Double backslashes, then put one behind the first character of every control string."""
    doubled = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    return F.regexp_replace(doubled, CONTROLS, "$0" + ESCAPE * 2)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, formatted, replies``.

    ``replies`` holds, for each assistant turn, where its escaped text begins
    (characters from 0) and how long it is. Turns are ordered by ``turn``; ties
    by role and text; a missing turn number sorts first. Null roles and texts
    are empty. Rows without a conversation id are one conversation. Repeated
    rows are turns of their own. Other columns are ignored. The text of one
    conversation is one value, and must fit into a task.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(F.col("turn"), role.alias("role"), text.alias("text"))
    grouped = turns.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("t")).alias("turns")
    )

    def piece(t: Column) -> Column:
        head = F.concat(F.lit(TURN), escape(t["role"]), F.lit(HEADER_END))
        return F.struct(
            (t["role"] == "assistant").alias("reply"), head.alias("head"), escape(t["text"]).alias("body")
        )

    pieces = grouped.select("conv_id", F.transform("turns", piece).alias("pieces"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("found"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + F.char_length(p["head"])
        length = F.char_length(p["body"])
        here = F.array(F.struct(begin.alias("start"), length.alias("length")))
        return F.struct(
            (begin + length + len(TURN_END)).alias("at"),
            F.when(p["reply"], F.concat(acc["found"], here)).otherwise(acc["found"]).alias("found"),
        )

    return pieces.select(
        "conv_id",
        F.size("pieces").cast("long").alias("n_turns"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(TURN_END))), "").alias(
            "formatted"
        ),
        F.aggregate("pieces", start, step, lambda acc: acc["found"]).alias("replies"),
    )


def expand_prefixes(formatted: DataFrame, outer: bool = False) -> DataFrame:
    """One example per assistant turn: ``example, text, loss_start, loss_length`` beside the input's columns.

    ``text`` ends with the end mark of the reply; the loss mask covers
    ``loss_length`` characters from ``loss_start`` (from 0). ``outer`` keeps
    conversations without a reply, with null example columns.
    """
    explode = F.posexplode_outer if outer else F.posexplode
    rows = formatted.select("*", explode("replies").alias("example", "r"))
    end = F.col("r.start") + F.col("r.length") + len(TURN_END)
    return rows.select(
        *formatted.columns,
        "example",
        F.substring("formatted", F.lit(1), end).alias("text"),
        F.col("r.start").alias("loss_start"),
        F.col("r.length").alias("loss_length"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""

    def turn(chunk: Column) -> Column:
        body = F.substring(chunk, F.lit(len(TURN) + 1), F.char_length(chunk))
        return let(
            F.split(body, r"<\|im_sep\|>", 2),
            lambda parts: F.struct(unescape(parts[0]).alias("role"), unescape(parts[1]).alias("text")),
        )

    chunks = F.filter(F.split(formatted, r"<\|im_end\|>", -1), lambda c: F.char_length(c) > 0)
    return F.transform(chunks, turn)


def read_loss(text: Column, start: Column, length: Column) -> Column:
    """What the loss mask of an example covers, as it was before escaping."""
    return unescape(F.substring(text, start + 1, length))


def conversation_digests(turns: DataFrame) -> DataFrame:
    """One row per conversation with digests read back from its formatted text and its examples."""
    examples = expand_prefixes(format_conversations(turns), outer=True)
    loss = F.when(
        F.col("example").isNotNull(), read_loss(F.col("text"), F.col("loss_start"), F.col("loss_length"))
    )
    # The rows of a conversation are still together: no second shuffle.
    whole = examples.groupBy("conv_id").agg(
        F.first("formatted").alias("formatted"),
        F.array_sort(F.collect_list(F.when(loss.isNotNull(), F.struct("example", loss.alias("loss"))))).alias("losses"),
        F.sum(F.char_length("text")).alias("example_chars"),
    )
    said = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    read = whole.select(
        "conv_id",
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        read_turns(F.col("formatted")).alias("turns"),
        said.alias("said"),
        F.size("losses").cast("long").alias("n_examples"),
        F.coalesce("example_chars", F.lit(0)).cast("long").alias("example_chars"),
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("said").cast("long").alias("loss_chars"),
        F.sha2("said", 256).alias("loss_sha256"),
        "formatted_chars",
        "n_examples",
        "example_chars",
    )
