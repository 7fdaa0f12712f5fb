"""Distinct counts kept up to date by mergeable sketches.

The store has a HyperLogLog sketch per (part, column): a part is a file, a day
or whatever column the caller names.  Rows of a part are read once, when it is
added; counts over any choice of parts are a union of stored sketches, a few
KB each, and no row is read again.  Adding a part twice changes nothing: the
union of a sketch with itself is that sketch.

The relative standard error of a count is about ``1.04 / sqrt(2**lg_k)``
(0.8 % with the default 14, at most 16 KB a sketch); a union of parts equals the
sketch of all their rows up to that error.  Nulls are not counted; an empty part
has no sketches and adds nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import file_exists

LG_K = 14
SCHEMA = "part string, column string, sketch binary, n bigint"


def standard_error(lg_k: int = LG_K) -> float:
    """Relative standard error of the counts."""
    return 1.04 / 2 ** (lg_k / 2)


def sketches(rows: DataFrame, cols: Sequence[str], part: Column | str,
             lg_k: int = LG_K) -> DataFrame:
    """(part, column, sketch, n): n non-null values of a column in a part.

    One aggregate over all columns; sketches are merged before the shuffle,
    so a hot part or value moves as one sketch per task.
    """
    part = F.col(part) if isinstance(part, str) else part
    values = [F.col(f"`{c}`").cast("string") for c in cols]
    wide = rows.groupBy(part.cast("string").alias("_kc_part")).agg(
        *[F.hll_sketch_agg(v, lg_k).alias(f"s{i}") for i, v in enumerate(values)],
        *[F.count(v).alias(f"n{i}") for i, v in enumerate(values)])
    return wide.select(F.col("_kc_part").alias("part"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("sketch"),
                 F.col(f"n{i}").alias("n")) for i, c in enumerate(cols)])))


def add(path: str, rows: DataFrame, cols: Sequence[str], part: Column | str,
        lg_k: int = LG_K) -> None:
    """Append the sketches of new rows to the store; what it holds is not read."""
    sketches(rows, cols, part, lg_k).write.mode("append").parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    """All stored sketches; empty for a store without any."""
    if not file_exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def counts(stored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, column, n_distinct) by union of the stored sketches, restricted and
    grouped beforehand as the caller likes."""
    return stored.groupBy(*by, "column").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))


def within(estimate: Column, exact: Column, lg_k: int = LG_K, deviations: float = 4.0) -> Column:
    """Whether a count lies within so many standard errors of the exact one (by one at
    least: small counts are whole numbers)."""
    return F.abs(estimate - exact) <= F.greatest(
        F.lit(1.0), exact * F.lit(deviations * standard_error(lg_k)))
