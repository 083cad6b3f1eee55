"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs, sorted by (turn, role, text), adjacent turns of
one role are merged into one message by an array fold, and messages are concatenated:

    <|start|>role<|message|>text<|part|>text ...<|end|>\\n

Every ``<``, ``[`` and ``\\`` inside roles and texts is followed by an added ``\\``; so no control string
(of this template or of those written with angle or square brackets) survives inside a text, and
dropping the added character gives the text back.  The loss mask holds the spans (from 0, in code
points) of each assistant text.

Defined results: null role or text is empty; null turns come first; repeated rows are turns of their
own; a null conv_id is a conversation; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, MESSAGE, PART, END = "<|start|>", "<|message|>", "<|part|>", "<|end|>\n"
_SPANS = "array<struct<start:int,length:int>>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def _merge(messages: Column, turn: Column) -> Column:
    """Appends a turn to the last message if that has its role, else as a new one."""
    last = F.element_at(messages, -1)
    same = (F.size(messages) > 0) & (F.get(messages, F.size(messages) - 1)["role"] == turn["role"])
    grown = F.struct(last["role"].alias("role"), F.concat(last["parts"], F.array(turn["text"])).alias("parts"))
    new = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("parts"))
    return F.when(same, F.concat(F.slice(messages, 1, F.size(messages) - 1), F.array(grown))).otherwise(F.concat(messages, F.array(new)))


def _append(state: Column, message: Column) -> Column:
    """Adds a message to the formatted text, and its texts to the loss mask if the assistant speaks."""
    head = F.concat(F.lit(START), message["role"], F.lit(MESSAGE))
    begin = F.length(state["text"]) + F.length(head)
    spans = F.aggregate(
        message["parts"],
        F.struct(begin.alias("at"), F.array().cast(_SPANS).alias("spans")),
        lambda a, p: F.struct((a["at"] + F.length(p) + len(PART)).alias("at"), F.concat(a["spans"], F.array(F.struct(a["at"].alias("start"), F.length(p).alias("length")))).alias("spans")),
        lambda a: a["spans"],
    )
    text = F.concat(state["text"], head, F.array_join(message["parts"], PART), F.lit(END))
    mask = F.when(message["role"] == "assistant", F.concat(state["loss_spans"], spans)).otherwise(state["loss_spans"])
    return F.struct(text.alias("text"), mask.alias("loss_spans"))


def format_chats(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: its id, formatted, loss_spans."""
    empty = F.lit("")
    rows = turns.select(
        F.col(conv_col).alias("_conv"),
        F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), empty).alias("role"), F.coalesce(F.col(text_col), empty).alias("text")).alias("t"),
    )
    chats = rows.groupBy("_conv").agg(F.array_sort(F.collect_list("t"), _by_turn).alias("turns"))
    safe = F.transform("turns", lambda t: F.struct(escaped(t["role"]).alias("role"), escaped(t["text"]).alias("text")))
    messages = F.aggregate(safe, F.array().cast("array<struct<role:string,parts:array<string>>>"), _merge)
    chats = chats.select("_conv", messages.alias("messages"))
    out = F.aggregate("messages", F.struct(empty.alias("text"), F.array().cast(_SPANS).alias("loss_spans")), _append)
    chats = chats.select("_conv", out.alias("out"))
    return chats.select(F.col("_conv").alias(conv_col), F.col("out.text").alias("formatted"), F.col("out.loss_spans").alias("loss_spans"))


def _compare(a: Column, b: Column) -> Column:
    return F.when(a.eqNullSafe(b), 0).when(a.isNull() | (a < b), -1).otherwise(1)


def _by_turn(a: Column, b: Column) -> Column:
    turn, role, text = (_compare(a[c], b[c]) for c in ("turn", "role", "text"))
    return F.when(turn != 0, turn).when(role != 0, role).otherwise(text)


def parsed_turns(formatted: Column) -> Column:
    """The turns, read back: array<struct<role,text>>."""
    messages = F.filter(F.split(formatted, r"<\|end\|>\n"), lambda m: m != "")
    pairs = F.transform(messages, lambda m: F.split(F.substr(m, F.lit(len(START) + 1)), r"<\|message\|>"))
    turns = F.transform(pairs, lambda p: F.transform(F.split(p[1], r"<\|part\|>"), lambda x: F.struct(unescaped(p[0]).alias("role"), unescaped(x).alias("text"))))
    return F.flatten(turns)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substr(formatted, s["start"] + 1, s["length"]))), "")
