"""Counts, rates and codes of the keys, kept up to date batch by batch.

The store has one row per (feature, value): ``n`` training rows, ``n_correct`` of
them, and ``code``.  New training files are merged in by their counts: the old
files are not read again.  Codes never change; values that are new get the next
codes of their feature, in order (null first, then ascending).

A version is a folder of its own, ``version-000001`` and so on, with the table
(``rates``, a folder per feature), the names of all batches merged so far
(``batches``) and, written last, the mark ``_DONE``.  Readers take the latest
marked version, so an update that fails leaves the store as it was; a batch
that is already in it is not counted twice.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rates import LABEL
from ..operators.sequence import running_index
from ..session import _file_system, file_exists

SCHEMA = "feature string, value string, n bigint, n_correct bigint, code bigint"
_VERSION = re.compile(r"version-(\d{6})$")


def latest(spark: SparkSession, path: str) -> int:
    """Number of the latest complete version; 0 for a store without any."""
    if not file_exists(spark, path):
        return 0
    fs, p = _file_system(spark, path)
    found = [(int(m[1]), f.getPath().toString()) for f in fs.listStatus(p)
             if (m := _VERSION.search(f.getPath().getName()))]
    return max((n for n, at in found if file_exists(spark, f"{at}/_DONE")), default=0)


def _folder(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/version-{version:06d}"


def load(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table of a version (the latest one by default)."""
    version = latest(spark, path) if version is None else version
    if not version:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(f"{_folder(path, version)}/rates").select(
        "feature", "value", "n", "n_correct", "code")


def batches(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(batch, version): the batches in a version, with the version that took each in."""
    version = latest(spark, path) if version is None else version
    if not version:
        return spark.createDataFrame([], "batch string, version int")
    return spark.read.schema("batch string, version int").parquet(
        f"{_folder(path, version)}/batches")


def merged(old: DataFrame, rows: DataFrame, keys: Sequence[str], label: str = LABEL) -> DataFrame:
    """The store's table with the counts of new training rows added (codes of new
    values still null): one aggregate, in which a hot value is combined before
    the shuffle."""
    pairs = rows.select(F.lit(1).cast("bigint").alias("n"),
                        F.when(F.col(label) == 1, 1).otherwise(0).cast("bigint").alias("n_correct"),
                        F.inline(F.array(*[
                            F.struct(F.lit(k).alias("feature"),
                                     F.col(k).cast("string").alias("value")) for k in keys])))
    new = pairs.groupBy("feature", "value").agg(F.sum("n").alias("n"),
                                                F.sum("n_correct").alias("n_correct"))
    return old.unionByName(new, allowMissingColumns=True).groupBy("feature", "value").agg(
        F.sum("n").alias("n"), F.sum("n_correct").alias("n_correct"), F.max("code").alias("code"))


def with_codes(counts: DataFrame) -> DataFrame:
    """Codes for the values that have none, after the last one of their feature."""
    last = counts.groupBy("feature").agg(
        (F.coalesce(F.max("code"), F.lit(-1))).alias("_kc_last"))  # a row per feature
    fresh = running_index(counts.where(F.col("code").isNull()), ["feature"],
                          [F.col("value").asc_nulls_first()], "_kc_pos")
    coded = fresh.join(F.broadcast(last), "feature").withColumn(
        "code", (F.col("_kc_last") + F.col("_kc_pos")).cast("bigint"))
    return counts.where(F.col("code").isNotNull()).unionByName(
        coded.select(*counts.columns))


def update(path: str, rows: DataFrame, batch: str, keys: Sequence[str],
           label: str = LABEL) -> int:
    """Merge new training rows into the store; the version that holds them.

    ``batch`` names the rows (say, their file): a batch that the store holds
    already is left out.
    """
    spark = rows.sparkSession
    now = latest(spark, path)
    known = batches(spark, path, now)
    if known.where(F.col("batch") == batch).limit(1).count():
        return now
    following = now + 1
    folder = _folder(path, following)
    fs, at = _file_system(spark, folder)
    fs.delete(at, True)  # what an update that failed has left
    with_codes(merged(load(spark, path, now), rows, keys, label)) \
        .write.partitionBy("feature").parquet(f"{folder}/rates")
    known.unionByName(spark.createDataFrame([(batch, following)], known.schema)) \
        .coalesce(1).write.parquet(f"{folder}/batches")  # a row per batch
    fs.create(_file_system(spark, f"{folder}/_DONE")[1]).close()
    return following


def rates(table: DataFrame, feature: str, out: str = "rate", stat: str = "rate",
          fallback: str = "mean") -> DataFrame:
    """The rate table of a feature, as ``operators.rates.rate_table`` builds it
    from all training rows."""
    own = table.where((F.col("feature") == feature) & F.col("value").isNotNull())
    if fallback == "drop":
        own = own.where(F.col("n_correct") > 0)
    value = F.col("n_correct") / F.col("n") if stat == "rate" else F.col("n_correct").cast("double")
    return own.select(F.col("value").alias(feature), value.alias(out))
