"""Feature tables kept as parquet, partitioned by split.

Models read the saved table instead of rebuilding the features; a reader
that asks for one split touches only that partition's files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_features(df: DataFrame, path: str, partition_col: str = "split") -> None:
    df.write.mode("error").partitionBy(partition_col).parquet(path)


def load_features(spark: SparkSession, path: str, split: str | None = None,
                  partition_col: str = "split") -> DataFrame:
    df = spark.read.parquet(path)
    return df.where(F.col(partition_col) == split) if split else df
