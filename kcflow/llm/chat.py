"""Chat formatting with collapse of cumulative snapshots.

A chat service that logs after every turn leaves conversations that begin
other, longer ones.  Each turn gets a hash of (position, role, text); the
sum of the first n hashes identifies the prefix of n turns, and the sum of
all turns identifies the conversation.  A conversation goes when its own
(length, sum) is a prefix of a longer one, or when an equal conversation
has a smaller id; an anti-join keeps the rest, which are rendered.

Sums can be taken in pieces: turns are numbered and summed in blocks of
BLOCK_TURNS, and a conversation that holds a third of all rows is many
blocks, never one task's group.  Rendered text comes in parts of
BLOCK_TURNS turns for the same reason; an ordinary conversation has one
part.

Defined results: turns without a conv_id belong to one conversation; rows
equal in conv_id, turn, role and text are one turn; turns with equal number
follow in order of role and text; turns without a number come first; a null
role is rendered as `unknown`, a null text as nothing; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kcflow.llm.common import materialise

BLOCK_TURNS = 512

#: Marks around a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def numbered_turns(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, at (0, 1, 2 ... in its conversation), role, text, without repeated rows.

    Turns are dealt into blocks by their number; positions inside a block are
    shifted by the sizes of the earlier blocks.
    """
    rows = turns.select(F.col(f"`{conv_id}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
                        F.col(f"`{role}`").alias("role"),
                        F.col(f"`{text}`").alias("text")).distinct()
    blocks = rows.withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS))
    sizes = blocks.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv").orderBy(F.col("block").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1)
    shift = sizes.select(F.col("conv").alias("c"), F.col("block").alias("b"),
                         F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    local = blocks.withColumn("at", F.row_number().over(
        Window.partitionBy("conv", "block").orderBy("turn", "role", "text")) - 1)
    same = F.col("conv").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b"))
    return local.join(shift, same).select("conv", (F.col("at") + F.col("shift")).alias("at"),
                                          "role", "text")


def maximal_conversations(numbered: DataFrame) -> DataFrame:
    """conv and n_turns of the conversations that no other begins with or equals."""
    hashed = numbered.select(
        "conv", "at", F.floor(F.col("at") / BLOCK_TURNS).alias("block"),
        # a hash skips nulls, so they are named
        F.xxhash64("at", F.col("role").isNull(), "role", F.col("text").isNull(), "text").alias("h1"),
        F.xxhash64("text", F.col("text").isNull(), "role", F.col("role").isNull(), "at").alias("h2"))
    in_block = Window.partitionBy("conv", "block").orderBy("at")

    def running(h: str, over) -> list[Column]:
        return [F.sum(F.shiftright(h, 32)).over(over).alias(f"{h}_hi"),
                F.sum(F.col(h).bitwiseAND(2**32 - 1)).over(over).alias(f"{h}_lo")]

    keys = ["h1_hi", "h1_lo", "h2_hi", "h2_lo"]
    local = hashed.select("conv", "at", "block", *running("h1", in_block), *running("h2", in_block))
    of_block = hashed.groupBy("conv", "block").agg(
        F.count(F.lit(1)).alias("n"),
        *[e for h in ("h1", "h2") for e in (
            F.sum(F.shiftright(h, 32)).alias(f"{h}_hi"),
            F.sum(F.col(h).bitwiseAND(2**32 - 1)).alias(f"{h}_lo"))])
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    everything = Window.partitionBy("conv")
    shifts = of_block.select(
        F.col("conv").alias("c"), F.col("block").alias("b"),
        F.sum("n").over(everything).alias("n_turns"),
        *[F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(f"{k}_before") for k in keys])
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))
    prefixes = local.join(shifts, same).select(
        "conv", (F.col("at") + 1).alias("n"), "n_turns",
        *[(F.col(k) + F.col(f"{k}_before")).alias(k) for k in keys])
    own = (prefixes.where("n = n_turns").groupBy("n", *keys)
           .agg(F.min(F.struct(F.col("conv").isNull().alias("last"), "conv")).alias("first"))
           .select("n", *keys, F.col("first.conv").alias("conv")))
    longer = prefixes.where("n < n_turns").select("n", *keys).distinct()
    return own.join(longer, ["n", *keys], "left_anti").select("conv", F.col("n").alias("n_turns"))


def format_chats(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """Rendered maximal conversations: conv_id, part, n_turns (of the whole
    conversation), turns (of the part) and text."""
    numbered = materialise(numbered_turns(turns, conv_id, turn, role, text), "turns")
    kept = maximal_conversations(numbered).select(F.col("conv").alias("c"), "n_turns")
    rendered = F.concat(F.lit(OPEN), F.coalesce("role", F.lit("unknown")), F.lit("\n"),
                        F.coalesce("text", F.lit("")), F.lit(CLOSE))
    parts = (numbered.join(kept, F.col("conv").eqNullSafe(F.col("c")))
             .groupBy("conv", F.floor(F.col("at") / BLOCK_TURNS).alias("part"))
             .agg(F.max("n_turns").alias("n_turns"), F.count(F.lit(1)).alias("turns"),
                  F.sort_array(F.collect_list(F.struct("at", rendered.alias("r")))).alias("t")))
    return parts.select(F.col("conv").alias(conv_id), F.col("part").cast("int").alias("part"),
                        F.col("n_turns").cast("long").alias("n_turns"), "turns",
                        F.array_join(F.col("t.r"), "\n").alias("text"))
