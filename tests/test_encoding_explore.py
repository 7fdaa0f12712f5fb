"""Codes, histograms, CDF and correlation properties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kcflow.operators import explore
from kcflow.operators.encoding import code_dictionaries, code_dictionary, encode_all
from kcflow.plans.features import feature_table


def test_codes_dense_null_first_shared(edge):
    train, test = edge.where("split = 'train'"), edge.where("split = 'test'")
    d = code_dictionary([train, test], "kc").orderBy("code").collect()
    assert [r["code"] for r in d] == list(range(len(d)))
    assert d[0]["kc"] is None
    assert [r["kc"] for r in d[1:]] == sorted(r["kc"] for r in d[1:])
    coded = encode_all(edge, code_dictionaries(edge, ["student"]), ["student"])
    codes = {r["student"] for r in coded.collect()}
    assert codes == {0, 1, 2, 3}


def test_stacked_dictionaries_equal_single(edge):
    many = code_dictionaries(edge, ["student", "problem"]).collect()
    for col in ("student", "problem"):
        one = {r[col]: r["code"] for r in code_dictionary([edge], col).collect()}
        assert {r["value"]: r["code"] for r in many if r["feature"] == col} == one


def test_feature_table_keeps_rows_and_fills(edge):
    ft = feature_table(edge.withColumn("problem_view", F.lit(1).cast("bigint")),
                       id_cols=("split", "row"))
    assert ft.count() == edge.count()
    test_d = ft.join(edge.select("row", F.col("student").alias("who")), "row") \
        .where("who = 'D'").first()
    assert test_d["problem_cfar"] == pytest.approx(4 / 9)
    assert test_d["personal_cfar"] == pytest.approx(1 / 2)
    assert test_d["step_cfar"] == pytest.approx(4 / 9)
    assert test_d["kc_cfar"] == pytest.approx(1 / 3)
    for c in ("personal_cfar", "problem_cfar", "step_cfar", "kc_cfar"):
        lo, hi = ft.agg(F.min(c), F.max(c)).first()
        assert 0.0 <= lo <= hi <= 1.0


def test_histogram_edges_and_cdf(spark):
    df = spark.createDataFrame([(x,) for x in [0.0, 0.5, 99.9, 100.0, 100.1, -1.0, None]], "x double")
    h = explore.histogram(df, "x", 100, 0.0, 100.0).orderBy("bin").collect()
    assert len(h) == 100
    assert h[0]["n"] == 2 and h[99]["n"] == 2          # last bin is closed
    assert sum(r["n"] for r in h) == 4                 # outside values left out
    cdf = explore.cumulative(explore.histogram(df, "x", 100, 0.0, 100.0)).orderBy("bin").collect()
    assert cdf[-1]["cdf"] == pytest.approx(1.0)
    counts, _ = np.histogram([0.0, 0.5, 99.9, 100.0], bins=100, range=(0, 100))
    assert [r["n"] for r in h] == counts.tolist()


def test_correlation_symmetric_constant_null(spark):
    rng = np.random.default_rng(1)
    rows = [(float(a), float(a * 2 + b), 1.0) for a, b in rng.normal(size=(200, 2))]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    m = {(r["col_a"], r["col_b"]): r["corr"] for r in explore.correlation_long(df, ["a", "b", "c"]).collect()}
    assert m[("a", "b")] == pytest.approx(m[("b", "a")])
    assert m[("a", "a")] == pytest.approx(1.0)
    assert m[("a", "c")] is None and m[("c", "c")] is None
    pdf = df.toPandas()
    assert m[("a", "b")] == pytest.approx(pdf["a"].corr(pdf["b"]))


def test_correlation_with_missing_values(spark):
    """Every statistic of a pair runs over the rows where both are present."""
    rows = [(1.0, 2.0), (2.0, None), (None, 9.0), (4.0, 1.0), (5.0, 7.0), (7.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    m = {(r["col_a"], r["col_b"]): r["corr"] for r in explore.correlation_long(df, ["a", "b"]).collect()}
    pdf = df.toPandas()
    assert m[("a", "b")] == pytest.approx(pdf["a"].corr(pdf["b"]))
    assert m[("a", "a")] == pytest.approx(1.0)


def _pairwise(x, y):
    both = ~(np.isnan(x) | np.isnan(y))
    x, y = x[both], y[both]
    if len(x) < 2 or not np.ptp(x) or not np.ptp(y):
        return None
    return float(np.corrcoef(x, y)[0, 1])


def test_correlation_of_many_columns_groups_and_parts(spark):
    """Pairwise over missing values, per group (a null one too), whatever the rows'
    partitions; constants, also those that are constant only where the other is
    present, give null; large means do not cost digits."""
    rng = np.random.default_rng(7)
    n, k = 400, 12
    x = rng.normal(size=(n, k)) + np.arange(k) * rng.normal(size=(n, 1))
    x[:, 1] += 1e6
    x[:, 2] = 0.1
    x[rng.random((n, k)) < 0.1] = np.nan
    x[:, 3] = np.where(np.arange(n) < 100, 0.3, x[:, 3])
    x[100:, 4] = np.nan
    x[:, 5], x[:, 6] = np.where(np.arange(n) % 2, x[:, 5], np.nan), np.where(
        np.arange(n) % 2, np.nan, x[:, 6])
    g = [("u", "v", None)[i % 3] for i in range(n)]
    cols = [f"c{i}" for i in range(k)]
    df = spark.createDataFrame([(g[i], *[None if np.isnan(v) else float(v) for v in x[i]])
                                for i in range(n)],
                               "g string, " + ", ".join(f"{c} double" for c in cols))
    got = explore.correlation_long(df.repartition(7), cols, ["g"]).collect()
    assert len(got) == 3 * k * k
    for r in got:
        here = np.array([v == r.g for v in g])
        want = _pairwise(x[here, cols.index(r.col_a)], x[here, cols.index(r.col_b)])
        assert r["corr"] is None if want is None else r["corr"] == pytest.approx(want, abs=1e-9), r


def test_correlation_aggregates_once_per_task(spark):
    """The statistics of all pairs come from one pass over blocks of rows: a plan with
    three aggregates a pair falls back to row-wise evaluation."""
    cols = [f"c{i}" for i in range(12)]
    df = spark.range(10).select(*[(F.col("id") * i).cast("double").alias(c)
                                  for i, c in enumerate(cols)])
    plan = explore.correlation_long(df, cols)._jdf.queryExecution().executedPlan().toString()
    assert "covar_samp" not in plan and "MapInArrow" in plan


def test_correlation_of_nan_and_of_no_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0, float("nan")), (2.0, 5.0, 1.0), (3.0, 1.0, 1.0)],
                               "a double, b double, c double")
    m = {(r.col_a, r.col_b): r["corr"] for r in explore.correlation_long(df, ["a", "b", "c"]).collect()}
    assert np.isnan(m["a", "c"]) and np.isnan(m["c", "c"]) and m["a", "b"] == pytest.approx(
        _pairwise(np.array([1.0, 2, 3]), np.array([2.0, 5, 1])))
    none = explore.correlation_long(df.where("false"), ["a", "b"]).collect()
    assert len(none) == 4 and all(r["corr"] is None for r in none)


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(3)
    vals = rng.exponential(18, 500).tolist()
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "d double")
    got = explore.describe(df, "d").first().asDict()
    ref = df.toPandas()["d"].describe()
    for ours, theirs in [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                         ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
        assert got[ours] == pytest.approx(ref[theirs])


def test_feature_table_count_and_drop_forms(edge):
    steps = edge.withColumn("problem_view", F.lit(1).cast("bigint"))
    # X1 count form: unseen student D gets the mean correct count 2/3, A its count 1
    ft = feature_table(steps, stat="count", id_cols=("split", "row"))
    who = ft.join(edge.select("row", F.col("student").alias("who"), F.col("step").alias("st")), "row")
    got = {(r["who"], r["st"], r["split"]): r["personal_cfar"] for r in who.collect()}
    assert got[("D", "s9", "test")] == pytest.approx(2 / 3)
    assert got[("A", "s1", "test")] == pytest.approx(1.0)
    # X2 drop form: only rows whose student, problem, step and KC all have a
    # correct training row survive: A/p1/s1/x~~y in train and in test
    kept = feature_table(steps, fallback="drop", id_cols=("split", "row"))
    rows = kept.join(edge.select("row", F.col("student").alias("who")), "row").collect()
    assert sorted((r["split"], r["who"]) for r in rows) == [("test", "A"), ("train", "A")]
    assert all(r["problem_cfar"] == pytest.approx(1 / 3) for r in rows)   # denominators: all rows


def test_one_hot_vectors_equal_the_encoder(spark):
    """The vectors are those of MLlib's encoder and assembler, without a name per slot."""
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler

    from kcflow.operators.encoding import one_hot_vectors, vector_indices

    df = spark.range(60_000).select(
        "id", F.col("id").alias("a"), (F.col("id") % 3).alias("b"),
        (F.col("id") % 7).cast("int").alias("c")).repartition(5)
    cols = ["b", "a", "c"]
    got = one_hot_vectors(df, cols)
    assert len(got._jdf.schema().json()) < 2000 and got.columns == [*df.columns, "one_hot"]
    hot = OneHotEncoder(inputCols=cols, outputCols=["x", "y", "z"], dropLast=False)
    few = df.where("id < 50")
    want = VectorAssembler(inputCols=["x", "y", "z"], outputCol="one_hot").transform(
        hot.fit(df).transform(few))
    ours = {r.id: r.one_hot for r in got.where("id < 50").collect()}
    assert ours == {r.id: r.one_hot for r in want.collect()} and ours[49].size == 60_010
    places = got.where("id = 49").select(vector_indices("one_hot").alias("i")).first().i
    assert list(places) == [1, 3 + 49, 3 + 60_000]


def test_one_hot_vectors_need_codes(spark):
    from kcflow.operators.encoding import one_hot_vectors

    for bad in (None, -1.0, 0.5):
        with pytest.raises(ValueError, match="1 rows"):
            one_hot_vectors(spark.createDataFrame([(0.0,), (bad,)], "a double"), ["a"])
