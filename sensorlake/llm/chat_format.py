"""Chat formatting by prefix-target expansion: every assistant turn becomes an example of its own,
with all preceding turns as context and only that reply trainable. DataFrame functions only.

Template: ``<turn ROLE>``, newline, text, ``</turn>``, newline. Inside roles and texts ``~``
becomes ``~0``, ``<`` becomes ``~1`` and ``>`` becomes ``~2``, so no text can imitate a marker and
``unescape`` restores every string exactly. The loss mask is a span of code points: the escaped
reply without its markers. A conversation that does not end with an assistant turn also gets an
example without loss, so the examples hold every turn.

The turns of one conversation meet in one task, as its last example holds them all in one string;
conversations spread over tasks by their id, and running offsets come from a window, not from
nested arrays. That examples repeat their prefixes is the method: k replies make k prefixes.

Defined cases: null text or role counts as empty; only the role ``assistant`` is trainable; turns
with the same number are ordered by role, then text, and all count; a null conversation id is one
conversation; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ASSISTANT = "assistant"
_CODES = (("~", "~0"), ("<", "~1"), (">", "~2"))


def escape(col):
    for plain, code in _CODES:
        col = F.replace(col, F.lit(plain), F.lit(code))
    return col


def unescape(col):
    for plain, code in reversed(_CODES):
        col = F.replace(col, F.lit(code), F.lit(plain))
    return col


def examples(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """One row per example: ``conv_id``, ``example`` (from 0), ``formatted``, ``loss_start`` and
    ``loss_length`` (code points of ``formatted``; length 0 where nothing is trainable)."""
    rows = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.withColumn("body", escape(F.col("text"))).withColumn(
        "seg", F.concat(F.lit("<turn "), escape(F.col("role")), F.lit(">\n"), "body",
                        F.lit("</turn>\n")))
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.select(
        "conv_id", "seg", F.row_number().over(in_order).alias("no"),
        F.sum(F.char_length("seg")).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
        .alias("end"),
        F.char_length("body").alias("length"), (F.col("role") == ASSISTANT).alias("reply"))
    convs = (rows.groupBy("conv_id")
             .agg(F.sort_array(F.collect_list(F.struct("no", "seg", "end", "length", "reply")))
                  .alias("t"))
             .select("conv_id", F.array_join(F.col("t.seg"), "").alias("whole"),
                     F.filter("t", lambda x: x["reply"] | (x["no"] == F.size("t"))).alias("t")))
    ends = convs.select("conv_id", "whole", F.posexplode(
        F.transform("t", lambda x: F.struct(x["end"], x["length"], x["reply"]))).alias("example",
                                                                                      "e"))
    tail = len("</turn>\n")
    return ends.select(
        "conv_id", "example", F.substring("whole", F.lit(1), F.col("e.end").cast("int"))
        .alias("formatted"),
        (F.col("e.end") - tail - F.col("e.length")).alias("loss_start"),
        F.when(F.col("e.reply"), F.col("e.length")).otherwise(0).alias("loss_length"))


def loss_text(formatted="formatted", start="loss_start", length="loss_length"):
    """The trainable text of an example, unescaped."""
    return unescape(F.substring(F.col(formatted), (F.col(start) + 1).cast("int"),
                                F.col(length).cast("int")))


def parse(formatted):
    """The turns of a formatted string, as an array of (role, text)."""
    parts = F.filter(F.split(formatted, "</turn>\n"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(
        unescape(p.substr(F.lit(len("<turn ") + 1), F.instr(p, ">") - len("<turn ") - 1))
        .alias("role"),
        unescape(p.substr(F.instr(p, ">") + 2, F.char_length(p))).alias("text")))


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from its examples alone: ``turns`` (role, text), ``loss`` (the trainable
    texts in order), ``formatted_chars``."""
    return formatted.withColumn("lost", loss_text()).groupBy("conv_id").agg(
        F.max(F.struct("example", "formatted")).alias("last"),
        F.sort_array(F.collect_list(F.struct("example", "lost"))).alias("lost"),
        F.sum(F.char_length("formatted")).alias("formatted_chars")).select(
        "conv_id", parse(F.col("last.formatted")).alias("turns"),
        F.array_join("lost.lost", "").alias("loss"), "formatted_chars")
