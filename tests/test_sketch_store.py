"""Stored sketches: unions of parts against the whole and the exact counts."""

import pytest
from pyspark.sql import functions as F

from kcflow.operators.explore import distinct_counts
from kcflow.session import scratch_path
from kcflow.sources import sketch_store as store
from kcflow.sources.fixtures import step_log
from tests.conftest import SF_SMALL

COLS = ("student", "problem", "step", "kc")


@pytest.fixture(scope="module")
def rows(spark):
    """Training rows with the file they come from, a third of them at one student."""
    return step_log(spark, SF_SMALL, with_row=True).where("split = 'train'").select(
        "row", (F.col("row") % 4).alias("file"),
        F.when(F.col("row") % 3 == 0, "HOT").otherwise(F.col("student")).alias("student"),
        "problem", "step", "kc").cache()


@pytest.fixture(scope="module")
def path(spark, rows):
    at = scratch_path(spark, "sketches")
    assert store.load(spark, at).count() == 0
    for k in range(4):
        store.add(at, rows.where(F.col("file") == k), COLS, "file")
    return at


def by_column(counted):
    return {r.column: r.n_distinct for r in counted.collect()}


def test_union_of_parts_equals_the_whole(spark, rows, path):
    whole = store.counts(store.sketches(rows, COLS, F.lit("all")))
    assert by_column(store.counts(store.load(spark, path))) == by_column(whole)


def test_error_against_exact_counts(spark, rows, path):
    exact = distinct_counts(rows, COLS).first()
    for column, n in by_column(store.counts(store.load(spark, path))).items():
        true = exact[f"n_{column}"]
        assert abs(n - true) <= max(1, 4 * store.standard_error() * true)


def test_parts_can_be_chosen_and_added_again(spark, rows, path):
    some = store.load(spark, path).where("part IN ('0', '2')")
    own = rows.where("file IN (0, 2)")
    exact = distinct_counts(own, COLS).first()
    got = by_column(store.counts(some))
    assert all(abs(got[c] - exact[f"n_{c}"]) <= max(1, 4 * store.standard_error() * got[c])
               for c in COLS)
    again = some.union(store.sketches(own, COLS, "file"))
    assert by_column(store.counts(again)) == got
    per_part = store.counts(some, ["part"])
    assert per_part.count() == 2 * len(COLS)
    assert {r.n for r in some.where("column = 'student'").select("n").collect()} == {
        r["count"] for r in own.groupBy("file").count().collect()}


def test_nulls_and_empty_parts(spark):
    rows = spark.createDataFrame([("a", None), ("a", None), ("b", "x"), (None, "y")],
                                 "part string, `odd.name` string")
    made = store.sketches(rows, ["odd.name"], "part")
    assert {(r.part, r.n) for r in made.collect()} == {("a", 0), ("b", 1), (None, 1)}
    assert store.counts(made).first().n_distinct == 2
    assert store.sketches(rows.where("false"), ["odd.name"], "part").count() == 0


def test_a_small_sketch_keeps_its_error(spark):
    rows = spark.range(60_000).select((F.col("id") % 20_000).alias("v"),
                                      (F.col("id") % 7).alias("day"))
    got = store.counts(store.sketches(rows, ["v"], "day", lg_k=10)).first().n_distinct
    assert abs(got - 20_000) <= 4 * store.standard_error(10) * 20_000
