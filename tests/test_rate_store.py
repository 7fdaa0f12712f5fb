"""Stored counts and codes: merged equals rebuilt, old codes stay, only new rows are read."""

import pytest
from pyspark.sql import functions as F

from kcflow.operators.rates import rate_table
from kcflow.session import scratch_path
from kcflow.sources import rate_store as store
from kcflow.sources.fixtures import step_log
from tests.conftest import SF_SMALL

KEYS = ("student", "problem", "step", "kc")


@pytest.fixture(scope="module")
def batch_files(spark):
    """Training rows as three files, a third of them at one student."""
    path = scratch_path(spark, "rate-batches")
    rows = step_log(spark, SF_SMALL, with_row=True).where("split = 'train'").select(
        "row", "cfa", *KEYS).withColumn(
            "student", F.when(F.col("row") % 3 == 0, "HOT").otherwise(F.col("student")))
    rows.withColumn("b", F.when(F.col("row") < 500, 0).otherwise(F.col("row") % 2 + 1)) \
        .write.partitionBy("b").parquet(path)
    return path


def codes(table):
    return {(r.feature, r.value): r.code for r in table.collect()}


def test_merged_equals_rebuilt(spark, batch_files):
    path, before = scratch_path(spark, "rate-store"), {}
    assert store.latest(spark, path) == 0 and store.load(spark, path).count() == 0
    for b in range(3):
        rows = spark.read.parquet(f"{batch_files}/b={b}")
        assert store.update(path, rows, f"b={b}", KEYS) == b + 1
        now = codes(store.load(spark, path))
        assert all(now[k] == c for k, c in before.items())  # old codes stay
        for key in KEYS:  # dense, and new values in order after the old ones
            own = sorted(c for (f, _), c in now.items() if f == key)
            assert own == list(range(len(own)))
            new = [v for (f, v), c in sorted(now.items(), key=lambda x: x[1])
                   if f == key and (f, v) not in before]
            assert new == sorted(new, key=lambda v: (v is not None, v or ""))
        before = now
    whole = spark.read.parquet(batch_files)
    table = store.load(spark, path)
    for key in KEYS:
        for how in ({}, {"stat": "count"}, {"fallback": "drop"}):
            got = {tuple(r) for r in store.rates(table, key, **how).collect()}
            assert got == {tuple(r) for r in rate_table(whole, key, **how).collect()}
    # a batch counts once, and earlier versions can still be read
    assert store.update(path, whole, "b=1", KEYS) == 3 == store.latest(spark, path)
    assert store.load(spark, path, 1).agg(F.sum("n")).first()[0] == 499 * len(KEYS)
    assert [r.batch for r in store.batches(spark, path).orderBy("version").collect()] == [
        "b=0", "b=1", "b=2"]


def test_only_new_files_are_read(spark, batch_files):
    path = scratch_path(spark, "rate-store")
    store.update(path, spark.read.parquet(f"{batch_files}/b=0"), "b=0", KEYS)
    new = spark.read.parquet(f"{batch_files}/b=1")
    read = store.merged(store.load(spark, path), new, KEYS).inputFiles()
    assert all("/b=1/" in f or "/version-000001/rates/" in f for f in read) and len(read) > 1


def test_failed_update_leaves_the_store(spark, batch_files):
    path = scratch_path(spark, "rate-store")
    rows = spark.read.parquet(f"{batch_files}/b=0")
    store.update(path, rows, "b=0", KEYS)
    bad = rows.withColumn("cfa", F.raise_error(F.lit("broken file")).cast("int"))
    with pytest.raises(Exception, match="broken file"):
        store.update(path, bad, "b=9", KEYS)
    assert store.latest(spark, path) == 1
    again = spark.read.parquet(f"{batch_files}/b=1")
    assert store.update(path, again, "b=1", KEYS) == 2
    assert store.load(spark, path).agg(F.sum("n")).first()[0] == (rows.count() + again.count()) * len(KEYS)


def test_empty_batch(spark, batch_files):
    path = scratch_path(spark, "rate-store")
    rows = spark.read.parquet(f"{batch_files}/b=0")
    assert store.update(path, rows.where("false"), "none", KEYS) == 1
    assert store.load(spark, path).count() == 0
    assert store.update(path, rows, "b=0", KEYS) == 2
    assert store.load(spark, path).count() > 0
