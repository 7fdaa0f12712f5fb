"""Prediction arithmetic and step-record construction against brute force."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from kcflow.functions.metrics import soft_vote, weighted_median
from kcflow.operators import steps as st
from kcflow.plans.submission import fill_labels, score
from tests.conftest import SF_SMALL


def _sk_weighted_median(preds, weights):
    order = np.argsort(preds, kind="stable")
    cdf = np.cumsum(np.asarray(weights)[order])
    idx = int(np.argmax(cdf >= 0.5 * cdf[-1]))
    return preds[order[idx]]


def test_weighted_median_brute_force(spark):
    rng = np.random.default_rng(5)
    preds = rng.random((50, 6)).round(2)
    w = [0.5, 1.0, 2.0, 0.1, 3.0, 0.7]
    df = spark.createDataFrame([tuple(map(float, r)) for r in preds], [f"p{i}" for i in range(6)])
    got = [r["m"] for r in df.select(weighted_median([f"p{i}" for i in range(6)], w).alias("m")).collect()]
    want = [_sk_weighted_median(r, w) for r in preds]
    assert got == pytest.approx(want)


def test_soft_vote_and_score(spark):
    df = spark.createDataFrame([(0.2, 0.6, 1), (0.9, 0.3, 0), (0.5, 0.5, None)], "a double, b double, y int")
    v = df.select(soft_vote(["a", "b"], [1.0, 1.5]).alias("prediction"), "y")
    vals = [r["prediction"] for r in v.collect()]
    assert vals == pytest.approx([(0.2 + 0.9) / 2.5, (0.9 + 0.45) / 2.5, 0.5])
    s = score(v, "prediction", "y").first()
    assert s["n"] == 2
    assert s["rmse"] == pytest.approx(np.sqrt(((0.44 - 1) ** 2 + 0.54 ** 2) / 2))


def test_fill_keeps_known_labels(edge):
    test = edge.where("split = 'test'").select("row", "cfa")
    pred = test.select("row", F.lit(1.7).alias("prediction"))
    out = {r["row"]: r["cfa"] for r in fill_labels(test, pred).collect()}
    known = {r["row"]: r["cfa"] for r in test.collect() if r["cfa"] is not None}
    for k, v in known.items():
        assert out[k] == v
    assert all(v == 1.0 for k, v in out.items() if k not in known)   # clamped to [0, 1]


def test_step_rollup_small(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, t0, "S1", "Q1", "main", "other", 1.0),
            (2, t0 + dt.timedelta(seconds=5), "S1", "Q1", "main", "hint", 2.0),
            (3, t0 + dt.timedelta(seconds=9), "S1", "Q1", "main", "correct", 3.0),
            (4, t0, "S2", "Q1", "main", "correct", 4.0),
            (5, t0 + dt.timedelta(seconds=1), "S2", "Q1", "main", "incorrect", 1.0),
            (6, t0, "S3", "Q2", "main", "other", 1.0)]
    tx = spark.createDataFrame(rows, "tx_id long, tx_time timestamp, student string, problem string, "
                                     "step string, outcome string, tx_dur double")
    got = {r["student"]: r for r in st.step_rollup(tx).collect()}
    assert got["S1"]["cfa"] == 0 and got["S1"]["hints"] == 1 and got["S1"]["corrects"] == 1
    assert got["S1"]["error_dur"] == 6.0 and got["S1"]["correct_dur"] is None
    assert got["S2"]["cfa"] == 1 and got["S2"]["correct_dur"] == 5.0 and got["S2"]["incorrects"] == 1
    assert got["S3"]["cfa"] is None and got["S3"]["first_tx"] is None


def test_opportunity_counts_brute_force(spark):
    rows = [("A", 1, "x~~y"), ("A", 2, "y"), ("A", 3, "x~~z"), ("B", 1, "x"), ("A", 4, None),
            ("C", 1, "a~~a"), ("C", 2, "b~~a~~b"), ("C", 3, ""), ("C", 4, "a~~b")]
    df = spark.createDataFrame(rows, "student string, t long, kc string")
    got = {(r["student"], r["t"]): r["o"] for r in
           st.opportunity_counts(df, ["student", "t"], ["t"], out="o").collect()}
    assert got == {("A", 1): "1~~1", ("A", 2): "2", ("A", 3): "2~~1", ("B", 1): "1",
                   # a KC that a step lists twice counts once
                   ("C", 1): "1~~1", ("C", 2): "1~~2~~1", ("C", 4): "3~~2"}


def test_holdout_split_parts(spark):
    rows = [("A", "U", "p1", 1), ("A", "U", "p2", 2), ("A", "U", "p3", 3), ("A", "U", "p2", 4)]
    df = spark.createDataFrame(rows, "student string, unit string, problem string, first_tx long")
    parts = {(r["problem"], r["first_tx"]): r["part"] for r in st.holdout_split(df).collect()}
    test_p = {p for (p, _), v in parts.items() if v == "test"}
    assert len(test_p) == 1
    start = min(t for (p, t) in parts if p in test_p)
    for (p, t), v in parts.items():
        if p not in test_p:
            assert v == ("train" if t < start else "discard")


def test_weighted_median_takes_the_half_once(spark):
    """The total is no part of the step over the array, or it is summed at every element."""
    from kcflow.functions.metrics import weighted_median

    df = spark.createDataFrame([(0.1, 0.5, 0.9), (0.7, None, 0.2)], "a double, b double, c double")
    out = df.select(weighted_median(["a", "b", "c"], [1.0, 2.0, 1.5]).alias("m"))
    plan = out._jdf.queryExecution().analyzed().toString()
    assert plan.rindex("array_sort") < plan.index("CASE WHEN")
    assert [r.m for r in out.collect()] == [0.5, 0.2]


def test_feature_rows_that_are_read_again_are_written_once(spark):
    from kcflow.plans.catalog import features, models

    for query, name in ((features.one_hot_sparse, "one-hot-input"),
                        (models.adaboost_round, "round-errors")):
        files = query(spark, SF_SMALL).inputFiles()
        assert files and all(name in f for f in files)


def test_submission_order_numbers_cells(spark, monkeypatch):
    """The written slices hold what is returned of a line, not the line."""
    from kcflow.operators import sequence
    from kcflow.plans.catalog import scoring

    seen = []

    def written(df, *args, **kw):
        seen.append(set(df.columns))
        return materialize(df, *args, **kw)

    materialize = sequence.materialize
    scoring.step_log(spark, SF_SMALL)  # prepared before
    monkeypatch.setattr(sequence, "materialize", written)
    scoring.submission_order(spark, SF_SMALL)
    assert seen == [{"row", "student", "label", "_kc_pid", "_kc_mid"}]
