"""Reading the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a scale-factor folder; columns are pruned by Catalyst."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, keys: list[str]) -> DataFrame:
    """Hash-repartition an input that arrives in fewer partitions than cores.

    A table stored as one parquet row group is read by one task, and every
    pass before the first shuffle then runs on one core.  Large inputs come
    as many files and skip this (no extra shuffle).  Hashing on a unique key
    keeps the layout deterministic, so a retried task sees the same rows.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
