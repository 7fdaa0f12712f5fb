"""The streaming roll-up over several micro-batches equals the batch roll-up."""

import os
import tempfile
from collections import Counter

import pyarrow.parquet as pq

from kcflow.operators.steps import step_rollup
from kcflow.sources.fixtures import transactions
from kcflow.streaming.rollup import compact, latest_records, run_rollup
from tests.conftest import SF_SMALL


def test_stream_in_four_batches_equals_batch(spark):
    events = pq.read_table(os.path.join(SF_SMALL, "events.parquet"))
    folder = tempfile.mkdtemp(prefix="kcflow-events-")
    n = events.num_rows
    # four files in time order: each becomes one micro-batch, and steps
    # spanning files are updated by later batches
    for i in range(4):
        part = events.slice(i * n // 4, (i + 1) * n // 4 - i * n // 4)
        pq.write_table(part, os.path.join(folder, f"events-{i}.parquet"))
    streamed = run_rollup(spark, folder)
    assert rows_of(streamed) == rows_of(step_rollup(transactions(spark, SF_SMALL)))


def rows_of(df):
    cols = sorted(df.columns)
    # sums over micro-batches add in another order: compare doubles to 9 places
    doubles = {c for c, t in df.dtypes if t == "double"}
    return Counter(tuple(round(r[c], 9) if c in doubles and r[c] is not None else r[c]
                         for c in cols) for r in df.select(*cols).collect())


def test_restart_reads_new_events_only(spark, tmp_path):
    """Stopped between files and started again, the stream goes on where it was."""
    events = pq.read_table(os.path.join(SF_SMALL, "events.parquet"))
    folder, out = tmp_path / "events", str(tmp_path / "steps")
    folder.mkdir()
    half = events.num_rows // 2
    pq.write_table(events.slice(0, half), folder / "events-0.parquet")
    run_rollup(spark, str(folder), out)
    before = spark.read.parquet(out).count()
    assert run_rollup(spark, str(folder), out).count() == before  # nothing new, nothing added
    assert spark.read.parquet(out).count() == before
    pq.write_table(events.slice(half), folder / "events-1.parquet")
    whole = rows_of(run_rollup(spark, str(folder), out))
    assert whole == rows_of(step_rollup(transactions(spark, SF_SMALL)))
    compact(spark, out, str(tmp_path / "compacted"))
    assert rows_of(latest_records(spark, str(tmp_path / "compacted"))) == whole
    assert spark.read.parquet(str(tmp_path / "compacted")).count() == sum(whole.values())
