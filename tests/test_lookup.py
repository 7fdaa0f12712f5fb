"""Lookups of several keys in one shuffle: same result, few exchanges, hot values."""

import pytest
from pyspark.sql import functions as F

from kcflow.operators.encoding import code_dictionaries, encode_all
from kcflow.operators.lookup import attach, hot_values, key_counts
from kcflow.plans.features import FEATURES, feature_table
from kcflow.sources.fixtures import step_log
from tests.conftest import SF_SMALL

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, "-1")
    yield spark
    spark.conf.set(THRESHOLD, before)


def hot_steps(spark):
    """A third of the rows at one student."""
    sl = step_log(spark, SF_SMALL, with_row=True)
    return sl.withColumn("student", F.when(F.col("row") % 3 == 0, F.lit("HOT")).when(
        F.col("row") % 50 == 1, F.lit(None)).otherwise(F.col("student")))


def table_rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in
                  df.fillna({"cfa": -1}).collect())


def nodes(plan):
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.initialPlan()
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


def exchanges_of(df, column):
    """Shuffles whose rows come from a scan that reads `column`."""
    def reads(node):
        return any(column in n.simpleStringWithNodeId() for n in nodes(node)
                   if n.nodeName().startswith("Scan"))
    return sum(n.nodeName() == "Exchange" and reads(n)
               for n in nodes(df._jdf.queryExecution().executedPlan()))


@pytest.mark.parametrize("fallback", ["mean", "drop"])
def test_same_table_without_broadcasts(spark, fallback):
    steps = hot_steps(spark)
    want = table_rows(feature_table(steps, fallback=fallback).select("split", "row", *FEATURES))
    before = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, "-1")
    try:
        stacked = feature_table(steps, fallback=fallback, hot_share=20)
        assert exchanges_of(stacked, "hierarchy") <= 3
        assert table_rows(stacked.select("split", "row", *FEATURES)) == want
    finally:
        spark.conf.set(THRESHOLD, before)


def test_rows_without_a_key_are_numbered(no_broadcast):
    steps = hot_steps(no_broadcast)
    want = feature_table(steps).select(*FEATURES)
    got = feature_table(steps.drop("row"), id_cols=("split",)).select(*FEATURES)
    assert table_rows(got) == table_rows(want)


def test_hot_values_are_few_and_salted(spark):
    counts = key_counts(hot_steps(spark), ["student", "problem"])
    hot = {(r.feature, r.value): r.salts for r in hot_values(counts, 20).collect()}
    assert len(hot) <= 40
    assert 6 <= hot["student", "HOT"] <= 8  # a third of the rows, a salt per 20th
    # unknown values of a key get nulls, and rows are neither lost nor doubled
    known = counts.where("value != 'HOT' OR value IS NULL").withColumn("code", F.lit(1))
    rows = hot_steps(spark)
    found = attach(rows, known, ["student", "problem"], ["code"], ["split", "row"], 20, limit=-1)
    assert found.count() == rows.count()
    assert found.where("_kc_student_code IS NULL AND student != 'HOT'").count() == 0
    assert found.where("student = 'HOT' AND _kc_student_code IS NOT NULL").count() == 0


def test_codes_agree(no_broadcast):
    rows = hot_steps(no_broadcast).select("split", "row", "student", "problem", "dur")
    cols = ("student", "problem")
    got = encode_all(rows, code_dictionaries(rows, cols), cols, ("split", "row"))
    students = sorted({r.student for r in rows.collect()}, key=lambda s: (s is not None, s or ""))
    names = {(r.split, r.row): r.student for r in rows.collect()}
    assert got.columns == rows.columns
    assert all(r.student == students.index(names[r.split, r.row]) for r in got.collect())


def test_empty(no_broadcast):
    steps = hot_steps(no_broadcast).where("false")
    assert feature_table(steps).collect() == []


def test_small_keys_are_found_before_rows_are_shuffled(spark):
    """Rows meet the pieces of the large keys last, with the numbers of the small ones."""
    rows = spark.range(60).selectExpr("id AS row", "'x' AS split", "concat('a', id) AS a",
                                      "concat('b', id % 2) AS b")
    dims = spark.sql("""SELECT 'a' AS feature, concat('a', id) AS value, 1L AS n_rows, id AS code
        FROM range(60) UNION ALL SELECT 'b', concat('b', id), 30L, id FROM range(2)""")
    out = attach(rows, dims, ["a", "b"], ["code"], ["split", "row"], limit=200)
    got = out.where("_kc_a_code = row AND _kc_b_code = row % 2")
    assert got.count() == 60
    joins = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines()
             if "Join " in x]
    assert "Inner" in joins[0] and len(joins) > 2
