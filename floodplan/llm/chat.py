"""Chat texts from logged conversations, without the snapshots of longer ones.

A conversation that was logged after every turn appears once for each of its prefixes. Two
rolling hashes over role, text and place identify every prefix; conversations whose whole
hash is that of a shorter prefix of another are dropped by an anti-join, and the rest are
rendered. Equal conversations count once, under the smallest id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floodplan.session import settle

START, END = "<|im_start|>", "<|im_end|>"


def _escaped(text: Column) -> Column:
    """The marks of a turn, where they stand in a text, are no marks."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, place, n, low, high): the hash of the first ``n`` turns at each place.

    Turns are ordered by number, role and text, nulls first. A hash is the exclusive-or of
    those of its turns with their places, in two halves of 64 bits.
    """
    hashed = turns.select(
        "conv_id",
        "turn",
        "role",
        F.xxhash64("role", F.col("role").isNull(), "text", F.col("text").isNull()).alias("one"),
        F.xxhash64(F.lit(7), "text", F.col("text").isNull(), "role", F.col("role").isNull()).alias("two"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "one", "two")
    numbered = hashed.withColumn("n", F.row_number().over(order))
    so_far = Window.partitionBy("conv_id").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    return numbered.select(
        "conv_id",
        "n",
        F.bit_xor(F.xxhash64("n", "one")).over(so_far).alias("low"),
        F.bit_xor(F.xxhash64("two", "n")).over(so_far).alias("high"),
        F.lead("n").over(Window.partitionBy("conv_id").orderBy("n")).isNull().alias("last"),
    )


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_equal) of conversations that are no prefix of a longer one."""
    found = settle(prefixes(turns))
    key = ["n", "low", "high"]
    whole = (
        found.filter("last")
        .groupBy(*key)
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_equal"),
        )
    )
    shorter = found.filter("NOT last").select(*key).distinct()
    return whole.join(shorter, key, "left_anti").select(
        "conv_id", F.col("n").cast("long").alias("n_turns"), "n_equal"
    )


def chat_texts(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_equal, chat), one row for each maximal conversation.

    Rows (conv_id, turn, role, text). Rows without a conv_id are one conversation of their
    own. A null role is written as "unknown" and a null text as an empty one, but both are
    told from these when conversations are compared. Repeated rows are turns of their own.
    """
    chosen = settle(maximal_conversations(turns))
    turn = F.concat(
        F.lit(START),
        _escaped(F.coalesce("role", F.lit("unknown"))),
        F.lit("\n"),
        _escaped(F.col("text")),
        F.lit(END + "\n"),
    )
    one = F.xxhash64("role", F.col("role").isNull(), "text", F.col("text").isNull())
    two = F.xxhash64(F.lit(7), "text", F.col("text").isNull(), "role", F.col("role").isNull())
    rows = turns.select(F.col("conv_id").alias("id"), "turn", "role", one.alias("one"), two.alias("two"), turn.alias("chat"))
    parts = rows.join(chosen, F.col("id").eqNullSafe(F.col("conv_id")))
    listed = F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull(), "turn", F.col("role").isNotNull(), "role", "one", "two", "chat")))
    return parts.groupBy("conv_id", "n_turns", "n_equal").agg(
        F.array_join(listed["chat"], "").alias("chat")
    )
