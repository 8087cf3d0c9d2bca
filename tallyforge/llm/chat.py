"""Chat formatting with Spark expressions only.

A conversation's turns are collected, sorted by turn (ties by role and text) and written as
``<|im_start|>role\\ntext<|im_end|>\\n``; adjacent turns of one role become one block whose texts ``<|im_sep|>`` separates. In
texts, control strings of this and of other common templates get a backslash behind their first character, and those with
backslashes there one more, so that they can be told from the template's own and restored. Roles are URL-encoded. The loss
mask marks the texts of ``assistant`` turns, without separators.

Null roles and texts are empty; a null conv_id is a conversation like any other; repeated rows are turns of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import _base as B

OPEN, CLOSE, SEP = "<|im_start|>", "<|im_end|>\n", "<|im_sep|>"
#: What follows the first character, ``<`` or ``[``, of a control string.
_TAILS = r"(\|(?:im_start|im_end|im_sep|endoftext)\|>|/?s>|/?INST\]|</?SYS>>)"
LOSS_ROLE = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*+)" + _TAILS, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*+)" + _TAILS, "$1$2$3")


def formatted(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, and segments (chunk, loss): the pieces of formatted in order and whether the loss mask holds them."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    turns = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), part("role"), part("text"))
    collected = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def pieces(s: Column) -> Column:
        def of(e: Column, i: Column) -> Column:
            same = lambda j: F.coalesce(F.get(s, j)["role"] == e["role"], F.lit(False))
            head = F.when(same(i - 1), SEP).otherwise(F.concat(F.lit(OPEN), F.url_encode(e["role"]), F.lit("\n")))
            tail = F.when(same(i + 1), "").otherwise(CLOSE)
            chunk = lambda c, loss: F.struct(c.alias("chunk"), loss.alias("loss"))
            return F.array(chunk(head, F.lit(False)), chunk(escaped(e["text"]), e["role"] == LOSS_ROLE), chunk(tail, F.lit(False)))

        return F.filter(F.flatten(F.transform(s, of)), lambda x: F.length(x["chunk"]) > 0)

    made = collected.select("conv_id", B.let(F.col("turns"), pieces).alias("segments"))
    return made.select("conv_id", F.array_join(F.transform("segments", lambda x: x["chunk"]), "").alias("formatted"), "segments")


def parsed(text: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""

    def block(b: Column) -> Column:
        name = F.substring_index(F.substring(b, len(OPEN) + 1, F.length(b)), "\n", 1)
        return B.let(name, lambda r: F.transform(F.split(F.substring(b, F.length(r) + F.lit(len(OPEN) + 2), F.length(b)), r"<\|im_sep\|>", -1), lambda t: F.struct(F.url_decode(r).alias("role"), unescaped(t).alias("text"))))

    blocks = lambda x: F.flatten(F.transform(F.slice(x, F.lit(1), F.size(x) - 1), block))
    return B.let(F.split(text, r"<\|im_end\|>\n", -1), blocks)


def digest(conversations: DataFrame) -> DataFrame:
    """What the formatted conversations give when they are read back."""
    done = formatted(conversations).select("conv_id", "formatted", parsed(F.col("formatted")).alias("turns"), F.array_join(F.transform(F.filter("segments", lambda x: x["loss"]), lambda x: unescaped(x["chunk"])), "").alias("loss"))
    return done.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
