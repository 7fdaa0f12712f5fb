"""Gapless numbers inside groups of any size.

A window over a whole group would put it into one task.  Rows are instead
dealt into blocks by hash, numbered inside (group, block), and shifted by
the sizes of the group's earlier blocks.  Only the block counts, one row
per group and block, are ordered per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Mean rows of one block; more rows mean more blocks, never longer ones.
ROWS_PER_BLOCK = 100_000


def gapless(df: DataFrame, group: list[str], by: list[str], out: str,
            rows: int | None = None, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Add `out`: 0, 1, 2 ... inside each `group`, the same on every run.

    `by` names columns that tell rows apart; equal rows get neighbouring
    numbers in either order.  `rows` is the row count, when known already.
    """
    n = df.count() if rows is None else rows
    blocks = n // rows_per_block + 1
    dealt = df.withColumn("_block", F.pmod(F.xxhash64(*by), F.lit(blocks)))
    key = [*group, "_block"]
    sizes = dealt.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1)
    shift = sizes.select(*key, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    local = dealt.withColumn(
        "_local", F.row_number().over(Window.partitionBy(*key).orderBy(*by)) - 1)
    return local.join(shift, key).withColumn(
        out, (F.col("_local") + F.col("_shift")).cast("long")).drop("_block", "_local", "_shift")
