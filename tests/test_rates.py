"""Rates, fallbacks and scalar features on the edge rows (literal expectations)."""

import pytest
from pyspark.sql import functions as F

from kcflow.functions import skills
from kcflow.operators.rates import add_rate, correct_counts, rate_table


def _map(df, k, v):
    return {r[k]: r[v] for r in df.collect()}


def test_problem_rates_and_mean(edge):
    train = edge.where("split = 'train'")
    t = _map(rate_table(train, "problem", "r"), "problem", "r")
    assert t == pytest.approx({"p1": 1 / 3, "p2": 1.0, "p3": 0.0})
    test = edge.where("split = 'test'")
    out = _map(add_rate(train, test, "problem", "r"), "problem", "r")
    assert out["p9"] == pytest.approx(4 / 9)
    assert out["p1"] == pytest.approx(1 / 3)


def test_drop_fallback(edge):
    train = edge.where("split = 'train'")
    t = _map(rate_table(train, "problem", "r", fallback="drop"), "problem", "r")
    assert set(t) == {"p1", "p2"}
    mean = rate_table(train, "problem", "r", fallback="drop").agg(F.avg("r")).first()[0]
    assert mean == pytest.approx(2 / 3)
    kept = add_rate(train, edge.where("split = 'test'"), "problem", "r", fallback="drop")
    assert sorted(r["problem"] for r in kept.collect()) == ["p1", "p2"]


def test_student_rate_and_count(edge):
    train = edge.where("split = 'train'")
    rates = _map(rate_table(train, "student", "r"), "student", "r")
    assert rates == pytest.approx({"A": 0.5, "B": 0.0, "C": 1.0})
    counts = _map(rate_table(train, "student", "r", stat="count"), "student", "r")
    assert counts == {"A": 1.0, "B": 0.0, "C": 1.0}
    test = edge.where("split = 'test'")
    d = _map(add_rate(train, test, "student", "r", stat="count"), "student", "r")
    assert d["D"] == pytest.approx(2 / 3)


def test_step_and_kc_rates(edge):
    train = edge.where("split = 'train'")
    steps = _map(rate_table(train, "step", "r"), "step", "r")
    assert steps == pytest.approx({"s1": 1 / 3, "s2": 0.0, "s3": 1.0})
    kcs = _map(rate_table(train, "kc", "r"), "kc", "r")
    assert kcs == pytest.approx({"x~~y": 1.0, "x": 0.0, "z": 0.0})
    test = edge.where("split = 'test'")
    out = {(r["student"], r["kc"]): r["r"] for r in add_rate(train, test, "kc", "r").collect()}
    assert out[("C", None)] == pytest.approx(1 / 3)   # null KC gets the mean
    assert out[("D", "w")] == pytest.approx(1 / 3)    # unseen KC gets the mean


def test_counts_keep_null_group(edge):
    c = correct_counts(edge.where("split = 'train'"), "kc")
    assert {r["kc"]: r["n"] for r in c.collect()}[None] == 2


def test_scalar_features(edge):
    rows = edge.where("split = 'train'").select(
        "student", "step", "problem",
        skills.unit_of("hierarchy").alias("unit"), skills.section_of("hierarchy").alias("section"),
        skills.kc_count("kc").alias("kc_num"),
        skills.opportunity_mean("opportunity").alias("om"),
        skills.opportunity_min("opportunity").alias("omin")).collect()
    by = {(r["student"], r["step"], r["problem"]): r for r in rows}
    r1 = by[("A", "s1", "p1")]
    assert (r1["kc_num"], r1["om"], r1["omin"]) == (2, 4.0, 3)
    r3 = by[("B", "s1", "p1")]
    assert (r3["kc_num"], r3["om"], r3["omin"]) == (0, 0.0, 0)
    assert r3["section"] == " Sec 2, b"
    r4 = by[("C", "s3", "p2")]
    assert r4["unit"] == "NoComma" and r4["section"] is None
