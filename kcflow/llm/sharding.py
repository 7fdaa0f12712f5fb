"""Sharding by jump consistent hashing.

A key jumps from shard to shard: from shard b it goes on to
floor((b + 1) / r), r uniform in (0, 1], until that is past the last shard;
the last shard reached is its own.  The i-th r depends on the key and i
alone, so one more shard only adds a possible last jump: a key stays where
it is or moves to the new shard, which takes its fair share.  No ring table
is kept and each row is placed by itself; the path is DataFrame functions
only.

Defined results: a null key is one more key value; a null text has 0 bytes
and the CRC of no bytes; repeated rows share a shard and get slots of their
own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kcflow.llm.numbering import gapless

#: Bytes that a stored row takes besides its text.
ROW_OVERHEAD = 8


def jump_shard(key: Column, shards: int) -> Column:
    """The shard of a key, 0 to shards - 1.  At most `shards` jumps are possible."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    def jump(state: Column, i: Column) -> Column:
        # 31 random bits give r = (bits + 1) / 2^31
        bits = F.shiftrightunsigned(F.xxhash64(key, i), 33)
        following = F.floor((state["j"] + 1) * F.lit(float(2**31)) / (bits + 1)).cast("long")
        return F.when(state["j"] < shards,
                      F.struct(state["j"].alias("b"), following.alias("j"))).otherwise(state)

    start = F.struct(F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))
    steps = F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))
    return F.aggregate(steps, start, jump, lambda s: s["b"]).cast("int")


def assign_shards(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text",
                  grown: int | None = None) -> DataFrame:
    """Shard and slot of every row.

    Returns the key, size (UTF-8 bytes plus `ROW_OVERHEAD`), text_crc32,
    shard, slot (0, 1, 2 ... in its shard) and grown_shard (with `grown`
    shards, one more by default).
    """
    body = F.coalesce(F.col(text), F.lit(""))
    placed = docs.select(
        F.col(key).alias("_key"),
        (F.octet_length(body) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        jump_shard(F.col(key), shards).alias("shard"),
        jump_shard(F.col(key), grown or shards + 1).alias("grown_shard"))
    numbered = gapless(placed, ["shard"], ["_key", "text_crc32"], "slot", rows=docs.count())
    return numbered.select(F.col("_key").alias(key), "size", "text_crc32", "shard", "slot",
                           "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int, key: str = "doc_id") -> None:
    """Write the rows as one folder per shard (`shard=0` ...), all columns kept."""
    name = "shard"
    while name in docs.columns:
        name = f"_{name}"
    docs.withColumn(name, jump_shard(F.col(key), shards)).write.partitionBy(name).parquet(path)
