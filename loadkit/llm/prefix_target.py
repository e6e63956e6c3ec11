"""Chat formatting by prefix-target expansion, with DataFrame functions only.

Every assistant turn is an example of its own: all preceding turns are the
context, and only the reply is trainable. All examples of a conversation are
beginnings of the same formatted conversation. So `expand` returns one row per
turn with its formatted segment and where it begins; an example is the segments
up to its target, and its loss span is given in code points from the beginning.
This keeps the result as large as the input, also for very long conversations;
`materialise` forms the text of every example from these rows.

A turn is `<|im_start|>role\\ntext<|im_end|>\\n`. In role and text, a `\\` is put
after the `<` of every `<`, `\\`..., `|`; taking it away again gives the text
back, and no text can hold a control string. A role's `%` and line feed become
`%25` and `%0A`, so a role is one line.

Defined results. Turns are ordered by turn (a missing one first), then role, then
text; repeated rows are turns of their own. A missing text or role is empty.
Rows of a missing conv_id are one conversation. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Turns of so many neighbouring numbers are numbered together; the blocks of a long conversation spread over tasks.
BLOCK = 1024


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def one_line(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def many_lines(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def expand(conversations: DataFrame, target: str = "assistant", conv: str = "conv_id", turn: str = "turn",
           role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn: conv_id, pos (from 0), segment, seg_start, is_target, loss_start, loss_chars.

    A row with `is_target` is an example: its text is the first `seg_start` plus
    length of `segment` code points of the conversation, its context the first `seg_start`, and its
    loss span `loss_chars` code points from `loss_start`.
    """
    empty = F.lit("")
    given = conversations.select(F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
                                 F.coalesce(F.col(f"`{role}`"), empty).alias("role"), F.coalesce(F.col(f"`{text}`"), empty).alias("text"))
    head = F.concat(F.lit(START), one_line(escape(F.col("role"))), F.lit("\n"))
    made = given.select("conv_id", "turn", "role", "text", head.alias("head"), escape(F.col("text")).alias("body"),
                        F.floor(F.coalesce(F.col("turn"), F.lit(-(2 ** 62))) / BLOCK).alias("block"))
    made = made.withColumn("segment", F.concat("head", "body", F.lit(END + "\n")))
    chars = F.length("segment").cast("long")
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    blocks = (made.groupBy("conv_id", "block").agg(F.count("*").alias("n"), F.sum(chars).alias("c"))
              .select(F.col("conv_id").alias("b_conv"), F.col("block").alias("b_block"),
                      F.coalesce(F.sum("n").over(before), zero).alias("n_before"),
                      F.coalesce(F.sum("c").over(before), zero).alias("c_before")))
    order = Window.partitionBy("conv_id", "block").orderBy(F.asc_nulls_first("turn"), "role", "text")
    inside = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = made.withColumns({"n_inside": F.row_number().over(order) - 1, "c_inside": F.coalesce(F.sum(chars).over(inside), zero)})
    placed = placed.join(blocks, F.col("conv_id").eqNullSafe(F.col("b_conv")) & (F.col("block") == F.col("b_block")))
    start = F.col("c_inside") + F.col("c_before")
    is_target = F.col("role") == target
    return placed.select("conv_id", (F.col("n_inside") + F.col("n_before")).cast("long").alias("pos"), "segment", start.alias("seg_start"),
                         is_target.alias("is_target"), F.when(is_target, start + F.length("head")).alias("loss_start"),
                         F.when(is_target, F.length("body").cast("long")).alias("loss_chars"))


def role_of(segment: Column) -> Column:
    """The role, read back from a segment."""
    return unescape(many_lines(F.regexp_extract(segment, r"(?s)^<\|im_start\|>(.*?)\n", 1)))


def text_of(segment: Column) -> Column:
    """The text, read back from a segment."""
    return unescape(F.regexp_extract(segment, r"(?s)^<\|im_start\|>.*?\n(.*)<\|im_end\|>\n$", 1))


def materialise(expanded: DataFrame) -> DataFrame:
    """(conv_id, pos, text, loss_start, loss_chars) of every example, text being context and reply.

    The result grows with the square of a conversation's turns, as the examples do. Examples whose targets are
    in one block of `BLOCK` turns are cut from one beginning, so those of a long conversation spread over tasks.
    """
    block = F.floor(F.col("pos") / BLOCK)
    blocks = expanded.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "segment"))).alias("turns"))
    blocks = blocks.select(F.col("conv_id").alias("w_conv"), "turns",
                           F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.size("turns") - 1) / BLOCK))).alias("w_block"))
    upto = F.slice("turns", 1, ((F.col("w_block") + 1) * BLOCK).cast("int"))
    blocks = blocks.select("w_conv", "w_block", F.array_join(F.transform(upto, lambda x: x["segment"]), "").alias("beginning"))
    end = (F.col("seg_start") + F.length("segment")).cast("int")
    met = F.col("conv_id").eqNullSafe(F.col("w_conv")) & (block == F.col("w_block"))
    return (expanded.where("is_target").join(blocks, met)
            .select("conv_id", "pos", F.substr("beginning", F.lit(1), end).alias("text"), "loss_start", "loss_chars"))


def reply_of(example: Column, loss_start: Column, loss_chars: Column) -> Column:
    """The reply, read back from an example's text under its loss mask."""
    return unescape(F.substr(example, (loss_start + 1).cast("int"), loss_chars.cast("int")))
