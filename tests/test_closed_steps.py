"""Visits closed by the stream equal a plain reading of the transactions, in
whatever order the files bring them, and closed visits leave the state."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.parquet as pq

from kcflow.streaming.closed_steps import closed_records, numbered_stream, run_closed_steps

GAP, DELAY = dt.timedelta(days=2), dt.timedelta(days=1)
START = dt.datetime(2024, 1, 1)
KIND = {"purchase": "correct", "error": "incorrect", "view": "hint"}


def write(folder, name, rows):
    cols = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    types = [pa.int64(), pa.timestamp("us"), pa.int64(), pa.string(), pa.float64(), pa.string()]
    pq.write_table(pa.table({c: pa.array([r[i] for r in rows], t)
                             for i, (c, t) in enumerate(zip(cols, types, strict=True))}),
                   folder / name)


def plain(rows):
    """(student, problem, first time, last time, cfa, transactions that count, view)."""
    by, last = defaultdict(list), max(r[1] for r in rows if r[1] is not None)
    for r in rows:
        if r[1] is not None:
            k = r[5] and int(r[5].split(":")[1].strip("} "))
            by[f"S{r[2]}" if r[2] is not None else None,
               None if k is None else f"Q{k % 10}"].append((r[1], r[0], KIND.get(r[3])))
    out = []
    for key, txs in by.items():
        visits = []
        for tx in sorted(txs):
            if not visits or tx[0] - visits[-1][-1][0] > GAP:
                visits.append([])
            visits[-1].append(tx)
        closed = [v for v in visits if v[-1][0] + GAP <= last - DELAY]
        for n, v in enumerate(closed, 1):
            tries = [o for _, _, o in v if o]
            out.append((*key, v[0][0], v[-1][0], int(tries[0] == "correct") if tries else None,
                        len(tries), n))
    return Counter(out)


def got(df):
    return Counter((r.student, r.problem, r.step_start, r.step_end, r.cfa,
                    r.incorrects + r.hints + r.corrects, r.problem_view) for r in df.collect())


def log_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # a third of all transactions belong to one student; whole hours make ties
        user = 0 if rng.random() < 0.34 else rng.choice([1, 2, 3, None])
        ts = None if rng.random() < 0.02 else START + dt.timedelta(hours=rng.randrange(24 * 40))
        kind = rng.choice(["purchase", "error", "view", "click", None])
        rows.append((i, ts, user, kind, rng.choice([1.0, None]),
                     rng.choice(['{"k": 3}', '{"k": 13}', '{"k": 4}', None])))
    return rows


def test_late_transactions_within_the_delay(spark, tmp_path):
    rows = log_rows(400, 1)
    rng = random.Random(2)
    # arrival is up to the delay later than the time
    arrival = sorted(rows, key=lambda r: (r[1] or START) + DELAY * rng.random())
    folder, out = tmp_path / "events", str(tmp_path / "log")
    folder.mkdir()
    for i in range(3):
        write(folder, f"events-{i}.parquet", arrival[i * 100:(i + 1) * 100])
    run_closed_steps(spark, str(folder), out)
    # stopped, more events, started again: open visits and numbers go on
    write(folder, "events-3.parquet", arrival[300:])
    result = run_closed_steps(spark, str(folder), out)
    want = plain(rows)
    assert got(result) == want
    assert max(k[-1] for k in want) > 3


def test_one_file_gives_the_same(spark, tmp_path):
    rows = log_rows(300, 3)
    write(tmp_path, "events.parquet", rows)
    assert got(run_closed_steps(spark, str(tmp_path), str(tmp_path / "log"))) == plain(rows)


def test_no_events(spark, tmp_path):
    write(tmp_path, "events.parquet", [])
    assert run_closed_steps(spark, str(tmp_path), str(tmp_path / "log")).collect() == []


def test_opportunities_and_state(spark, tmp_path):
    """Numbers per student and KC, and a state that holds open visits only."""
    schema = ("tx_id long, tx_time timestamp, student string, problem string, step string, "
              "outcome string, tx_dur double, kc string")
    folder = tmp_path / "tx"
    rows = [(i, START + dt.timedelta(days=i), f"S{i % 2}", f"P{i % 5}", f"T{i}", "correct", 1.0,
             "add") for i in range(60)]
    for part in range(6):
        spark.createDataFrame(rows[part * 10:part * 10 + 10], schema).coalesce(1) \
            .write.mode("append").parquet(str(folder))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    keys = ["student", "problem", "step", "kc"]
    numbered = numbered_stream(closed_records(stream, keys=keys), ["student", "kc"], "opportunity")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        query = (numbered.writeStream.outputMode("append").format("parquet")
                 .option("path", str(tmp_path / "out"))
                 .option("checkpointLocation", str(tmp_path / "ckpt"))
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    closed = [r for r in rows if r[0] <= 56]  # day 59 less one for late ones, less the gap
    assert {(r.student, r.step, r.opportunity) for r in out} == {
        (r[2], r[4], r[0] // 2 + 1) for r in closed}
    held = [op["numRowsTotal"] for op in query.recentProgress[-1]["stateOperators"]]
    # the three open visits, and one number for each of the two groups
    assert sorted(held) == [2, 3]
