"""Step records closed, numbered and evicted as the transaction stream goes on.

Where ``rollup`` keeps every step for good, here a step ends: a student who
leaves a step for longer than ``gap`` has finished that visit, and coming back
begins a new record.  Two stateful operators in one streaming query:

1. A session-window aggregation per (student, problem, step), with the batch
   roll-up's aggregates and partial merging before the shuffle.  A
   transaction up to ``delay`` late still corrects its open record.  Once the
   watermark (latest time seen less ``delay``) has passed a record's last
   transaction by ``gap``, the record is emitted and leaves the state.
2. A keyed processor holding one number per group (such as student and
   problem, or student and KC): how many records it has emitted.  Records
   leave the first operator in the order of their last transaction, so the
   number that a record gets (its problem view, or its opportunity) is final
   when it is written, and the log is only ever appended to.

State: the open records of the last ``gap + delay``, and one long per group.
The processor orders the records of one group within one micro-batch, one row
per visit; the source bounds a micro-batch (``files_per_batch``).

Defined results: a transaction without a time belongs to no visit and is left
out; null keys are keys like others; records with the same last time are
numbered by their first time and step, null first; a transaction later than
``delay`` after its record was closed begins a new record or is dropped by the
watermark.  The log is a parquet folder of the file sink, whose manifest makes
a replayed micro-batch count once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.steps import finish_rollup, rollup_aggregates
from ..session import ensure_worker_path, scratch_path
from ..sources.fixtures import transactions_of
from .rollup import KEYS, events_stream

GAP, DELAY = "2 days", "1 day"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def closed_records(tx: DataFrame, gap: str = GAP, delay: str = DELAY,
                   keys: Sequence[str] = KEYS) -> DataFrame:
    """One record per visit of a step, from a transaction stream (append
    output) or a batch of transactions (all visits, open ones included)."""
    timed = tx.withColumn("_kc_last", F.col("tx_time").cast("timestamp")).withWatermark("_kc_last", delay)
    rolled = timed.groupBy(*keys, F.session_window("_kc_last", gap).alias("_kc_visit")).agg(
        *rollup_aggregates())
    return finish_rollup(rolled, [*keys, "_kc_visit"]).drop("_kc_visit")


class Numbering(StatefulProcessor):
    """Numbers a group's records in the order of their last times, going on
    from the number the group had reached before this micro-batch."""

    def __init__(self, order: Sequence[str], out: str):
        self.order, self.out = list(order), out

    def init(self, handle) -> None:
        self.reached = handle.getValueState("reached", "n long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        records = sorted(rows, key=lambda r: [(r[c] is not None, r[c]) for c in self.order])
        reached = self.reached.get()
        before = reached[0] if reached else 0
        if records:
            self.reached.update((before + len(records),))
        for i, record in enumerate(records, before + 1):
            yield Row(**record.asDict(), **{self.out: i})

    def close(self) -> None:
        pass


def numbered_stream(records: DataFrame, group: Sequence[str], out: str,
                    order: Sequence[str] = ("step_end", "step_start", "step")) -> DataFrame:
    """``records`` of an append-mode stream with the running number ``out`` per
    ``group``.  ``order`` begins with the time by which records are closed."""
    schema = StructType([*records.schema.fields, StructField(out, LongType())])
    return records.groupBy(*group).transformWithState(
        statefulProcessor=Numbering(order, out), outputStructType=schema,
        outputMode="Append", timeMode="None")


def run_closed_steps(spark: SparkSession, sf_dir: str, out_path: str | None = None,
                     checkpoint: str | None = None, gap: str = GAP, delay: str = DELAY,
                     files_per_batch: int = 1) -> DataFrame:
    """Run over the events until the input is drained; return the log of closed
    records with ``problem_view``.  Calling again with the same folders reads
    new events only and goes on with the open records."""
    out_path = out_path or scratch_path(spark, "closed-steps")
    ckpt = checkpoint or f"{out_path.rstrip('/')}-checkpoint"
    ensure_worker_path(spark)
    tx = transactions_of(events_stream(spark, sf_dir, files_per_batch))
    numbered = numbered_stream(closed_records(tx, gap, delay), ["student", "problem"],
                               "problem_view")
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)  # the keyed processor needs this state store
    try:
        query = (numbered.writeStream.outputMode("append").format("parquet")
                 .option("path", out_path).option("checkpointLocation", ckpt)
                 .trigger(availableNow=True).start())
    finally:
        spark.conf.set(PROVIDER, before)
    query.awaitTermination()
    return spark.read.schema(numbered.schema).parquet(out_path)
