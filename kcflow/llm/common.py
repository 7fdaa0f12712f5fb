"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kcflow.session import ensure_checkpoint_dir, scratch_path
from kcflow.sources.tables import table

#: The white space of the contracts: space and \t \n \v \f \r.
ASCII_SPACE = " \t\n\x0b\x0c\r"

#: Rows of whole texts that go to Python at once.
BATCH_ROWS = 2000

#: Internal id of a document whose doc_id is null: it ranks after all others.
LAST_ID = 2**63 - 1


def id_key(column: str = "doc_id") -> Column:
    """doc_id as a long, with null as one document after all others."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))


def id_back(key: str | Column) -> Column:
    """The doc_id that `id_key` was made from."""
    key = F.col(key) if isinstance(key, str) else key
    return F.when(key != LAST_ID, key)


def packed(df: DataFrame) -> Column:
    """The whole input row as one struct, so no added name can clash with its columns."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def unpacked(df: DataFrame, struct: str, columns: list[str], **replaced: Column) -> DataFrame:
    """The packed input columns again, with some of them replaced."""
    return df.select(*[(replaced[c] if c in replaced else F.col(f"{struct}.`{c}`")).alias(c)
                       for c in columns])


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back.

    Used where a result is read more than once: the written table cuts the
    lineage and survives lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int = BATCH_ROWS):
    """At most so many rows at once go to Python in the jobs that run inside:
    whole texts make batches large, on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return table(spark, sf_dir, "documents")
