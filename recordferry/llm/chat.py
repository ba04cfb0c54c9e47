"""Chat formatting with Spark expressions only.

The turns of a conversation are sorted by (turn, role, text) and collected as structs.  Adjacent turns of one role share a
block.  The template:

    <|role|>text<+>text<|end|>        a block; <+> parts the texts of merged turns

Texts and roles are escaped (& < | become &amp; &lt; &bar;), so no control string can come out of them, and unescaping in
reverse order gives them back.  `loss_spans` are the [start, end) code-point offsets of the assistant texts in `formatted`.

Null text or role counts as empty, a null turn sorts first, rows with a null conversation id form one conversation, repeated
rows stay repeated turns.  Turns are shuffled once, by conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("|", "&bar;"))


def escape(text: Column) -> Column:
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for plain, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def format_chats(turns: DataFrame, assistant: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss_spans array<struct<start,end>> from rows (conv_id, turn, role, text).

    Offsets are running sums over the turns, made before the turns are collected, so a conversation costs its length.
    """
    rows = turns.select(turns["conv_id"].alias("conv_id"), turns["turn"].alias("turn"),
                        escape(F.coalesce(turns["role"], F.lit(""))).alias("role"), F.coalesce(turns["text"], F.lit("")).alias("raw"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "raw")
    opening = F.concat(F.lit("<|"), F.col("role"), F.lit("|>"))
    before = F.lag("role").over(order)
    head = (F.when(before.isNull(), opening).when(before == F.col("role"), F.lit("<+>"))
            .otherwise(F.concat(F.lit("<|end|>"), opening)))
    pieces = rows.select("conv_id", "role", F.row_number().over(order).alias("at"), "turn", "raw", head.alias("head"), escape(F.col("raw")).alias("body"))
    size = F.char_length("body")
    end = F.sum(F.char_length("head") + size).over(
        Window.partitionBy("conv_id").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    placed = pieces.select("conv_id", F.struct(
        "at", F.concat("head", "body").alias("piece"), (F.col("role") == assistant).alias("loss"),
        (end - size).alias("start"), end.alias("end")).alias("piece"))
    collected = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    spans = F.transform(F.filter("pieces", lambda p: p["loss"]), lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end")))
    return collected.select("conv_id", F.concat(F.array_join("pieces.piece", ""), F.lit("<|end|>")).alias("formatted"),
                            spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role,text>>, in order: what the template holds, merged turns parted again."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>", -1), lambda b: b != "")

    def parted(block: Column) -> Column:
        role = F.substring_index(F.substring(block, 3, 2147483647), "|>", 1)
        body = F.substring(block, F.char_length(role) + 5, F.lit(2147483647))
        return F.transform(F.split(body, r"<\+>", -1), lambda t: F.struct(unescape(role).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, parted))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int")))), "")
