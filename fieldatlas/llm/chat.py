"""Chat formatting with cumulative-snapshot collapse.

A logging system that stores the conversation so far after every turn leaves
many conversations that are prefixes of longer ones. Each turn gets a rolling
prefix hash: the running XOR of position-tagged 64-bit turn hashes, twice, with
different seeds (128 bits; XOR of hashes that include the position is an
order-sensitive rolling hash and needs no running concatenation). A
conversation whose full hash occurs as a proper prefix of another is removed
by an anti-join, one of several equal ones by a second one, and only what is
left is rendered. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TURN_TEMPLATE = "<|im_start|>{role}\n{text}<|im_end|>\n"


def _turns(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    return conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).dropDuplicates(["conv", "turn", "role", "text"])


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv, pos (from 1), n_turns, h1, h2 of the prefix that ends at pos."""
    by_turn = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    so_far = by_turn.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tagged = turns.withColumn("pos", F.row_number().over(by_turn)).withColumns(
        {
            "t1": F.xxhash64(F.col("pos"), F.col("role"), F.col("text")),
            "t2": F.xxhash64(F.lit("second"), F.col("text"), F.col("pos"), F.col("role")),
        }
    )
    return tagged.select(
        "conv",
        "pos",
        F.count(F.lit(1)).over(Window.partitionBy("conv")).cast("int").alias("n_turns"),
        F.bit_xor("t1").over(so_far).alias("h1"),
        F.bit_xor("t2").over(so_far).alias("h2"),
    )


def maximal(turns: DataFrame) -> DataFrame:
    """conv and n_turns of the conversations that are no prefix of another one.

    Equal conversations are represented by the smallest id.
    """
    hashed = prefix_hashes(turns)
    full = (
        hashed.where("pos = n_turns")
        .groupBy("n_turns", "h1", "h2")
        .agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_equal"))
    )
    inner = hashed.where("pos < n_turns").select("pos", "h1", "h2").distinct()
    same = (full.n_turns == inner.pos) & (full.h1 == inner.h1) & (full.h2 == inner.h2)
    return full.join(inner, same, "left_anti").select("conv", "n_turns", "n_equal")


def format_chats(
    conversations: DataFrame, id_col="conv_id", turn_col="turn", role_col="role", text_col="text", template: str = TURN_TEMPLATE
) -> DataFrame:
    """One row per maximal conversation: conv_id, n_turns, n_equal, rendered.

    Turns are ordered by number (null last), then role and text; a turn that
    repeats in every column counts once. A null role renders as "unknown", a
    null text as empty. Rows without a conversation id belong to no
    conversation and are left out. Other columns are not read, whatever their
    names. An empty table gives an empty result. ``n_equal`` is the number of
    logged conversations identical to this one, itself included.
    """
    turns = _turns(conversations, id_col, turn_col, role_col, text_col)
    kept = maximal(turns)
    head, rest = template.split("{role}", 1)
    middle, tail = rest.split("{text}", 1)
    piece = F.concat(F.lit(head), F.col("role"), F.lit(middle), F.col("text"), F.lit(tail))
    # Nulls sort last through the flag; the struct then orders as the hashes did.
    part = F.struct(F.col("turn").isNull().alias("late"), "turn", "role", "text", piece.alias("piece"))
    chats = (
        turns.join(kept, "conv")
        .groupBy("conv")
        .agg(F.first("n_turns").alias("n_turns"), F.first("n_equal").alias("n_equal"), F.array_sort(F.collect_list(part)).alias("parts"))
    )
    return chats.select(
        F.col("conv").alias(id_col), F.col("n_turns").cast("long").alias("n_turns"), "n_equal", F.array_join(F.col("parts.piece"), "").alias("rendered")
    )
