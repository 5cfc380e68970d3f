"""Conversations as training text with a loss mask, with Spark expressions only.

A message is ``<|im_start|>role\\ntext<|im_end|>\\n``. Neighbouring turns of one
role share a message, their texts parted by ``<|im_part|>``. In roles and texts
a backslash is doubled and ``<|`` becomes ``<\\|``, and a line feed in a role
becomes ``<|im_line|>``; so no text can hold a marker, and reading back is
exact. The mask covers the texts of assistant turns and nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.llm.expressions import let, up_to

START, END, PART, LINE = "<|im_start|>", "<|im_end|>\n", "<|im_part|>", "<|im_line|>"
LEARNED = "assistant"


def _escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def _unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _escape_role(role: Column) -> Column:
    return F.replace(_escape(role), F.lit("\n"), F.lit(LINE))


def _unescape_role(role: Column) -> Column:
    return _unescape(F.replace(role, F.lit(LINE), F.lit("\n")))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conv_id: conv_id, formatted, loss_spans array<struct<start,stop>> in code points.

    Turns are ordered by turn, then role, then text; null roles and texts are
    empty ones, a null turn comes first, and the null conv_id is one
    conversation. Repeated rows are repeated turns. A conversation is one
    string, so one row holds it whole. Other columns are not looked at.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    sorted_turns = turns.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(
        F.sort_array(F.collect_list("t")).alias("turns"))

    def merged(t: Column) -> Column:
        """The text pieces of the conversation, each with what stands before it."""
        same = lambda i: F.coalesce(F.get(t, i)["role"] == F.get(t, i - 1)["role"], F.lit(False))

        def piece(i: Column) -> Column:
            role = F.get(t, i)["role"]
            opening = F.concat(F.when(i > 0, F.lit(END)).otherwise(F.lit("")), F.lit(START), _escape_role(role),
                               F.lit("\n"))
            return F.struct(F.when((i > 0) & same(i), F.lit(PART)).otherwise(opening).alias("before"),
                            _escape(F.get(t, i)["text"]).alias("body"), (role == LEARNED).alias("learned"))

        return F.transform(up_to(F.size(t)), piece)

    pieces = sorted_turns.select("conv_id", let(F.col("turns"), merged).alias("pieces"))
    stops = F.aggregate(
        "pieces", F.array().cast("array<int>"), lambda acc, p: F.concat(acc, F.array(
            F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + F.char_length(p["before"]) + F.char_length(p["body"]))))
    staged = pieces.withColumn("stops", F.when(F.size("pieces") > 0, stops))
    spans = F.filter(F.transform("pieces", lambda p, i: F.struct(
        (F.get("stops", i) - F.char_length(p["body"])).alias("start"), F.get("stops", i).alias("stop"),
        p["learned"].alias("learned"))), lambda s: s["learned"])
    return staged.select(
        "conv_id",
        F.concat(F.array_join(F.transform("pieces", lambda p: F.concat(p["before"], p["body"])), ""), F.lit(END))
        .alias("formatted"),
        F.transform(spans, lambda s: F.struct(s["start"], s["stop"])).alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role,text>>: the turns of a formatted conversation."""
    def turns(message: Column) -> Column:
        role = F.substring_index(message, "\n", 1)
        body = F.substring(message, F.char_length(role) + 2, F.char_length(message) - F.char_length(role) - 1 - len(END))
        return F.transform(F.split(body, r"<\|im_part\|>"), lambda text: F.struct(
            _unescape_role(role).alias("role"), _unescape(text).alias("text")))

    return F.flatten(F.transform(F.array_remove(F.split(formatted, r"<\|im_start\|>"), ""), turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(spans, lambda s: _unescape(
        F.substring(formatted, s["start"] + 1, s["stop"] - s["start"]))), "")
