"""Conversations as training text, with built-in functions only.

A conversation's turns are collected as structs and sorted. Neighbours with one role share a heading: the
first opens it, the others follow a mark. Control strings all start with "<", which never appears inside
a text: "\\" is written as "\\b" and "<" as "\\l", so any text, also one that looks like a control string, can be
read back as it was. The loss mask lists where the assistant's texts stand in the UTF-8 bytes of the output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TURN, TEXT, MORE, END = "<|turn|>", "<|text|>", "<|more|>", "<|end|>\n"
LEARNED = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, loss_spans (start and length in bytes, in order).

    Turns are ordered by turn, then role, then text, nulls first; repeated rows are turns of their own. A null
    role or text is empty. Rows without conv_id are one conversation. Other columns don't matter; an empty table
    gives an empty result. A conversation is one row of output, so its size is bounded by what one row may hold.
    """
    rows = turns.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    sorted_turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))

    def piece(t: Column, i: Column) -> Column:
        opens = (i == 0) | (F.get("t", i - 1)["role"] != t["role"])
        closes = (i == F.size("t") - 1) | (F.get("t", i + 1)["role"] != t["role"])
        return F.struct(
            F.when(opens, F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT))).otherwise(MORE).alias("head"),
            escape(t["text"]).alias("body"),
            F.when(closes, END).otherwise("").alias("tail"),
            (t["role"] == LEARNED).alias("learned"),
        )

    pieces = sorted_turns.select("conv_id", F.posexplode(F.transform("t", piece)).alias("at", "p"))
    upto = W.partitionBy("conv_id").orderBy("at").rowsBetween(W.unboundedPreceding, W.currentRow)
    n = [F.octet_length(f"p.{c}") for c in ("head", "body", "tail")]
    placed = pieces.withColumn("end", F.sum((n[0] + n[1] + n[2]).cast("long")).over(upto)).select(
        "conv_id",
        F.struct(
            "at",
            F.concat("p.head", "p.body", "p.tail").alias("written"),
            F.when(F.col("p.learned"), F.struct((F.col("end") - n[2] - n[1]).alias("start"), n[1].alias("length"))).alias("loss"),
        ).alias("w"),
    )
    return (
        placed.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("w")).alias("w"))
        .select(
            "conv_id",
            F.size("w").cast("long").alias("n_turns"),
            F.array_join(F.col("w.written"), "").alias("formatted"),
            F.filter("w.loss", lambda s: s.isNotNull()).alias("loss_spans"),
        )
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns (role, text) and the text under the loss mask, from the output alone: conv_id, turns, loss_text, formatted."""
    parts = F.filter(F.split("formatted", r"<\|end\|>\n", -1), lambda b: b != "")

    def turns(block: Column) -> Column:
        halves = F.split(F.replace(block, F.lit(TURN), F.lit("")), r"<\|text\|>", -1)
        return F.transform(
            F.split(halves[1], r"<\|more\|>", -1),
            lambda text: F.struct(unescape(halves[0]).alias("role"), unescape(text).alias("text")),
        )

    under = F.transform(
        "loss_spans",
        lambda s: F.decode(F.substring(F.col("bytes"), (s["start"] + 1).cast("int"), s["length"].cast("int")), "utf-8"),
    )
    return formatted.withColumn("bytes", F.encode("formatted", "utf-8")).select(
        "conv_id",
        F.flatten(F.transform(parts, turns)).alias("turns"),
        unescape(F.array_join(under, "")).alias("loss_text"),
        "formatted",
    )
