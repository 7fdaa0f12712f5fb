"""Looking up several key columns of a table in one dictionary.

A dictionary has one row per (feature, value), null included, with value
columns (a code, a rate ...) and ``n_rows``, the rows that hold the value.
Six joins in a row would shuffle the whole wide row six times once the
dictionaries are too large to broadcast.  Here the small ones are broadcast
(their size is measured against the session's
``spark.sql.autoBroadcastJoinThreshold``) and all the others are met together:

1. rows become narrow pieces (row key, feature, value);
2. pieces and dictionary meet once by (feature, value); a value held by more
   than 1/HOT_SHARE of the rows is dealt by a salt on both sides, and there can be
   at most HOT_SHARE such values per feature, a bound for the table of them;
3. pieces come back as one row per row key and are joined to the rows by it.

Those are three exchanges of step rows however many key columns there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequence import materialize

#: A value is hot when it holds more than this part of the rows.
HOT_SHARE = 1000
#: Estimated bytes of a broadcast dictionary row besides the text of its value.
ROW_BYTES = 48


def key_counts(rows: DataFrame, keys: Sequence[str], *aggs: Column,
               extra: Sequence[Column] = ()) -> DataFrame:
    """``(feature, value, n_rows)`` of several key columns in one pass, null
    values included, with further aggregates over the ``extra`` columns."""
    stacked = rows.select(*extra, F.inline(F.array(*[
        F.struct(F.lit(k).alias("feature"), F.col(k).cast("string").alias("value"))
        for k in keys])))
    return stacked.groupBy("feature", "value").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"), *aggs)


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes (negative: never)."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        text)) if not text.lstrip("-").isdigit() else int(text)


def _name(key: str, value: str) -> str:
    return f"_kc_{key}_{value}"


def _broadcast(rows: DataFrame, own: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    dim = own.select(F.col("value").alias("_kc_value"),
                     *[F.col(v).alias(_name(key, v)) for v in values])
    return rows.join(F.broadcast(dim), F.col(key).cast("string").eqNullSafe(F.col("_kc_value")),
                     "left").drop("_kc_value")


def hot_values(dims: DataFrame, hot_share: int = HOT_SHARE) -> DataFrame:
    """``(feature, value, salts)`` of the values with more than 1/hot_share of
    a feature's rows: at most ``hot_share`` per feature."""
    totals = dims.groupBy("feature").agg(F.sum("n_rows").alias("_kc_all"))
    salts = F.ceil(F.col("n_rows") * hot_share / F.col("_kc_all"))
    return dims.join(F.broadcast(totals), "feature").where(  # a row per key column
        F.col("n_rows") * hot_share > F.col("_kc_all")).select(
            "feature", "value", salts.cast("int").alias("salts"))


def _stacked(rows: DataFrame, dims: DataFrame, keys: Sequence[str], values: Sequence[str],
             row_key: Sequence[str], hot_share: int) -> DataFrame:
    hot = F.broadcast(hot_values(dims, hot_share).select(
        F.col("feature").alias("_kc_hf"), F.col("value").alias("_kc_hv"), "salts"))
    is_hot = (F.col("feature") == F.col("_kc_hf")) & F.col("value").eqNullSafe(F.col("_kc_hv"))
    salts = F.coalesce("salts", F.lit(1))
    pieces = rows.select(*row_key, F.inline(F.array(*[
        F.struct(F.lit(k).alias("feature"), F.col(k).cast("string").alias("value"))
        for k in keys])))
    pieces = pieces.join(hot, is_hot, "left").select(
        *row_key, "feature", "value", F.pmod(F.xxhash64(*row_key), salts).alias("_kc_salt"))
    dealt = dims.select("feature", "value", *values).join(hot, is_hot, "left").select(
        F.col("feature").alias("_kc_f"), F.col("value").alias("_kc_v"), *values,
        F.explode(F.sequence(F.lit(0).cast("bigint"), (salts - 1).cast("bigint"))).alias("_kc_s"))
    met = pieces.join(dealt, (F.col("feature") == F.col("_kc_f"))
                      & F.col("value").eqNullSafe(F.col("_kc_v"))
                      & (F.col("_kc_salt") == F.col("_kc_s")), "left")
    # dealt by row key first, so that both steps of the aggregate run without a further exchange
    back = met.repartition(*[F.col(k) for k in row_key]).groupBy(*row_key).agg(*[
        F.max(F.when(F.col("feature") == k, F.col(v))).alias(_name(k, v))
        for k in keys for v in values])
    back = back.withColumnsRenamed({k: f"_kc_row_{i}" for i, k in enumerate(row_key)})
    same = F.lit(True)
    for i, k in enumerate(row_key):
        same = same & (F.col(k) == F.col(f"_kc_row_{i}"))
    return rows.join(back, same).drop(*[f"_kc_row_{i}" for i in range(len(row_key))])


def attach(rows: DataFrame, dims: DataFrame, keys: Sequence[str], values: Sequence[str],
           row_key: Sequence[str] = (), hot_share: int = HOT_SHARE,
           limit: int | None = None) -> DataFrame:
    """``rows`` with a column ``_kc_<key>_<value column>`` per key and value column
    (null where the dictionary lacks the value); the value columns are numbers.

    ``row_key`` names not-null columns that tell rows apart; without them the
    rows are written once with a number.  ``dims`` is read several times and
    should be a written table; ``limit`` replaces the session's threshold.
    """
    limit = broadcast_limit(rows) if limit is None else limit
    sizes = {r.feature: r.bytes for r in dims.groupBy("feature").agg(F.sum(
        F.coalesce(F.octet_length("value"), F.lit(0)) + ROW_BYTES).alias("bytes")).collect()}
    large = [k for k in keys if sizes.get(k, 0) > limit]  # one row per key column
    columns = rows.columns
    if large and not row_key:
        rows = materialize(rows.withColumn("_kc_id", F.monotonically_increasing_id()),
                           "lookup-rows")
    # first, so that a row is shuffled with the numbers found and not with its texts
    for k in keys:
        if k not in large:
            rows = _broadcast(rows, dims.where(F.col("feature") == k), k, values)
    if large:
        rows = _stacked(rows, dims.where(F.col("feature").isin(large)), large, values,
                        list(row_key) or ["_kc_id"], hot_share)
    return rows.select(*columns, *[_name(k, v) for k in keys for v in values])
