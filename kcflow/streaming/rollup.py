"""Step records maintained from a transaction stream.

The same per-step aggregates as the batch roll-up run as a stateful
streaming aggregation keyed by (student, problem, step); the state store
holds one partial record per step, partitioned by the key like any shuffle.

Output runs in update mode: each micro-batch appends only the step records
it changed, tagged with its batch id, to a parquet folder (nothing is
collected to the driver, nothing already written is rewritten).  Readers
take the latest version of every step with one aggregate.  A micro-batch
replayed after a failure appends the same rows again, which the latest-
version read absorbs.  The stream's checkpoint lies beside the output (or
where the caller says), so a job started again with the same output resumes
where the last one stopped.  ``compact`` rewrites the change log to one row
per step.

State: one partial record (a dozen numbers) per (student, problem, step) ever
seen.  A step can be continued at any time, so nothing expires; the state
grows with the distinct steps, not with the transactions, and is spread over
the shuffle partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.steps import finish_rollup, rollup_aggregates
from ..session import scratch_path
from ..sources.fixtures import transactions_of

KEYS = ("student", "problem", "step")
BATCH_COL = "_kc_batch"


def step_records_stream(tx_stream: DataFrame) -> DataFrame:
    """Streaming step records (update or complete output) from streaming transactions."""
    return finish_rollup(tx_stream.groupBy(*KEYS).agg(*rollup_aggregates()), KEYS)


def events_stream(spark: SparkSession, sf_dir: str, files_per_batch: int = 1) -> DataFrame:
    """The events table read as a file stream (new files become micro-batches)."""
    folder = sf_dir.rstrip("/")
    schema = spark.read.option("pathGlobFilter", "events*.parquet").parquet(folder).schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .option("pathGlobFilter", "events*.parquet").parquet(folder))


def latest_records(spark: SparkSession, path: str) -> DataFrame:
    """The current step records: per step, the version of the latest batch."""
    log = spark.read.parquet(path)
    cols = [c for c in log.columns if c not in (*KEYS, BATCH_COL)]
    latest = log.groupBy(*KEYS).agg(
        F.max_by(F.struct(*cols), F.col(BATCH_COL)).alias("_kc_rec"))
    return latest.select(*KEYS, *[F.col(f"_kc_rec.{c}").alias(c) for c in cols])


def compact(spark: SparkSession, path: str, out: str) -> None:
    """Write the change log at ``path`` to ``out`` with one row per step: the
    latest version, under its batch id."""
    log = spark.read.parquet(path)
    latest = log.groupBy(*KEYS).agg(
        F.max_by(F.struct(*[c for c in log.columns if c not in KEYS]), F.col(BATCH_COL))
        .alias("_kc_rec"))
    latest.select(*KEYS, "_kc_rec.*").write.parquet(out)


def run_rollup(spark: SparkSession, sf_dir: str, out_path: str | None = None,
               checkpoint: str | None = None) -> DataFrame:
    """Run the streaming roll-up over the events until the input is drained;
    return the current step records as a batch DataFrame.

    ``checkpoint`` holds the stream's progress and state; by default it is
    ``<out_path>-checkpoint``.  Calling again with the same folders reads new
    events only."""
    out_path = out_path or scratch_path(spark, "stream-steps")
    ckpt = checkpoint or f"{out_path.rstrip('/')}-checkpoint"
    records = step_records_stream(transactions_of(events_stream(spark, sf_dir)))

    def append_changes(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn(BATCH_COL, F.lit(batch_id).cast("bigint")) \
            .write.mode("append").parquet(out_path)

    query = (records.writeStream.outputMode("update").foreachBatch(append_changes)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    query.awaitTermination()
    return latest_records(spark, out_path)
