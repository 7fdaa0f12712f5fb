"""Correct-first-attempt rates per key, with fallbacks for unseen keys.

Two behaviours exist for the same feature (see SURVEY section 1.4):

* ``fallback='mean'`` - left join the rate table; rows whose key is null or
  unseen get the unweighted mean of the group values (all groups, 0-rate
  ones included).
* ``fallback='drop'`` - only keys with at least one correct row have a rate
  and rows without one are dropped (inner join); the mean then runs over
  those groups only.

``stat='rate'`` gives correct / total, ``stat='count'`` the number of
correct rows.  Denominators always count the original training rows, so the
result does not depend on the order in which features are added.

Scale: the rate table is one partial + final aggregate (map-side combine,
so a hot key is pre-aggregated before the shuffle).  It is joined back by
name; AQE turns the join into a broadcast only when the measured size of
the rate table is under the broadcast threshold, otherwise it stays a
shuffle join whose hot keys AQE splits.  The fallback mean is a scalar
subquery over the (already aggregated) rate table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABEL = "cfa"


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def correct_counts(train: DataFrame, key: str | Sequence[str], label: str = LABEL) -> DataFrame:
    """Per key: ``n_correct`` (label = 1) and ``n`` (all rows); null key kept as a group."""
    ks = _keys(key)
    return train.groupBy(*ks).agg(
        F.count_if(F.col(label) == 1).cast("bigint").alias("n_correct"),
        F.count(F.lit(1)).cast("bigint").alias("n"))


def rate_table(train: DataFrame, key: str | Sequence[str], out: str = "rate",
               stat: str = "rate", fallback: str = "mean", label: str = LABEL) -> DataFrame:
    """Rate (or correct count) per non-null key."""
    ks = _keys(key)
    counts = correct_counts(train, ks, label)
    for k in ks:
        counts = counts.where(F.col(k).isNotNull())
    if fallback == "drop":
        counts = counts.where(F.col("n_correct") > 0)
    elif fallback != "mean":
        raise ValueError("fallback must be 'mean' or 'drop'")
    if stat == "rate":
        value = F.col("n_correct") / F.col("n")
    elif stat == "count":
        value = F.col("n_correct").cast("double")
    else:
        raise ValueError("stat must be 'rate' or 'count'")
    return counts.select(*ks, value.alias(out))


def mean_of(rates: DataFrame, col: str) -> Column:
    """Unweighted mean of a rate table, as a scalar subquery column."""
    return rates.agg(F.avg(col)).scalar()


def apply_rate(rows: DataFrame, rates: DataFrame, key: str | Sequence[str], col: str,
               fallback: str = "mean") -> DataFrame:
    """Attach ``col`` from ``rates`` to ``rows`` by key, with the chosen fallback."""
    ks = _keys(key)
    if fallback == "drop":
        return rows.join(rates, ks, "inner")
    joined = rows.join(rates, ks, "left")
    return joined.withColumn(col, F.coalesce(F.col(col), mean_of(rates, col)))


def add_rate(train: DataFrame, rows: DataFrame, key: str | Sequence[str], col: str,
             stat: str = "rate", fallback: str = "mean", label: str = LABEL) -> DataFrame:
    """Rate of ``key`` learnt on ``train``, attached to ``rows``."""
    table = rate_table(train, key, col, stat=stat, fallback=fallback, label=label)
    return apply_rate(rows, table, key, col, fallback=fallback)


def stacked_counts(train: DataFrame, keys: Sequence[str], label: str = LABEL) -> DataFrame:
    """(key, value, n, n_correct) for several key columns in one pass over the
    rows; null values are left out."""
    pairs = train.select((F.col(label) == 1).alias("_kc_ok"), F.inline(F.array(*[
        F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys])))
    return pairs.where(F.col("value").isNotNull()).groupBy("key", "value").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.count_if(F.col("_kc_ok")).cast("bigint").alias("n_correct"))
