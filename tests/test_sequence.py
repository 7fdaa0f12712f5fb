"""Running numbers and exact quantiles against windows and brute force."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kcflow.operators.sequence import exact_quantiles, running_index


@pytest.fixture(scope="module")
def skewed(spark):
    # one hot group holding about a third of the rows, plus many small ones
    rng = np.random.default_rng(7)
    n = 3000
    g = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 200, n))
    rows = [(int(a), int(i), float(v)) for a, i, v in zip(g, range(n), rng.normal(10, 3, n))]
    return spark.createDataFrame(rows, "g long, id long, v double")


def test_sliced_equals_window(skewed):
    a = skewed.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("id")))
    b = running_index(skewed, ["g"], ["id"], "rn", num_partitions=7)
    ra = {r["id"]: r["rn"] for r in a.collect()}
    rb = {r["id"]: r["rn"] for r in b.collect()}
    assert ra == rb and len(ra) == skewed.count()


def test_running_index_brute_force(skewed):
    pdf = skewed.toPandas().sort_values(["g", "id"])
    pdf["rn"] = pdf.groupby("g").cumcount() + 1
    got = {r["id"]: r["rn"] for r in running_index(skewed, ["g"], ["id"], "rn").collect()}
    assert got == dict(zip(pdf["id"], pdf["rn"]))


def test_global_numbering_dense(skewed):
    out = running_index(skewed, [], ["v", "id"], "pos", num_partitions=5)
    assert sorted(r["pos"] for r in out.collect()) == list(range(1, skewed.count() + 1))


@pytest.mark.parametrize("slices", [1, 9])
def test_quantiles_match_numpy(skewed, slices):
    q = exact_quantiles(skewed, "v", [0.25, 0.5, 0.75], group_cols=["g"],
                        num_partitions=slices).collect()
    pdf = skewed.toPandas()
    for r in q:
        vals = pdf.loc[pdf.g == r["g"], "v"].to_numpy()
        assert r["q25"] == pytest.approx(np.quantile(vals, 0.25))
        assert r["q50"] == pytest.approx(np.median(vals))
        assert r["q75"] == pytest.approx(np.quantile(vals, 0.75))


def test_quantiles_skip_nulls(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (1, 3.0), (2, None)], "k int, x double")
    got = {r["k"]: r["m"] for r in exact_quantiles(df, "x", [0.5], ["k"], names=["m"]).collect()}
    assert got == {1: 2.0}


def test_systematic_counts_equal_plain_draws(spark):
    """Hot weights, zero and null weights, against draws one by one."""
    import bisect
    import itertools

    from kcflow.operators.sequence import sliced, systematic_counts

    n = 3000
    weights = [0.0 if i % 11 == 0 else None if i % 13 == 0 else 500.0 if i == 77 else 1 + i % 5
               for i in range(n)]
    df = spark.createDataFrame([(i, w and float(w)) for i, w in enumerate(weights)],
                               "id long, w double").repartition(5)
    ranged = sliced(df, [F.col("id")], 6)
    got = {r.id: r.drawn for r in systematic_counts(ranged, "w", n, "drawn", 0.3).collect()}
    ends = list(itertools.accumulate(w or 0.0 for w in weights))
    want = dict.fromkeys(range(n), 0)
    for k in range(n):
        want[bisect.bisect_right(ends, (0.3 + k) * ends[-1] / n)] += 1
    assert got == want and sum(got.values()) == n
    total = ends[-1]
    for i, w in enumerate(weights):
        assert abs(got[i] - n * (w or 0.0) / total) < 1
    none = systematic_counts(sliced(df.where("false"), [F.col("id")], 2), "w", 0, "drawn")
    assert none.collect() == []


def test_nulls_nans_and_zeros_are_groups_over_many_slices(spark):
    rows = [(None if i % 5 == 0 else f"g{i % 3}", [None, float("nan"), 0.0, -0.0][i % 4], i)
            for i in range(400)]
    df = spark.createDataFrame(rows, "g string, x double, id long")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g", "x").orderBy("id")))
    want = {r["id"]: r["rn"] for r in want.collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for n in (1, 4, 60):
            got = running_index(df, ["g", "x"], ["id"], "rn", num_partitions=n,
                                group_count_col="n").collect()
            assert {r["id"]: r["rn"] for r in got} == want
            assert all(r["rn"] <= r["n"] for r in got) and sum(r["rn"] == r["n"] for r in got) == 12
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert running_index(df.where("false"), ["g"], ["id"], "rn").count() == 0


def test_numbered_rows_are_shuffled_once(skewed):
    """The offsets are a row per slice, however many groups: no join shuffles the rows again."""
    conf = skewed.sparkSession.conf
    before = conf.get("spark.sql.autoBroadcastJoinThreshold")
    conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = running_index(skewed, ["g"], ["id"], "rn", num_partitions=5)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_running_sums_and_whole_groups(spark):
    from kcflow.operators.sequence import running_sum

    rows = [(None if i % 7 == 0 else i % 3 == 0, i, 1 + i % 5) for i in range(300)]
    df = spark.createDataFrame(rows, "g boolean, id long, n long").repartition(4)
    upto = Window.partitionBy("g").orderBy("id")
    want = {r.id: (r.s, r.p) for r in df.withColumns({
        "s": F.sum("n").over(upto), "p": F.row_number().over(upto)}).collect()}
    for parts in (1, 5, 40):
        got = running_sum(df, ["g"], ["id"], "n", "s", parts).collect()
        assert {r.id: r.s for r in got} == {i: s for i, (s, _) in want.items()}
    whole = running_index(df, ["g"], ["id"], "p", keep=["id"], largest=300)
    assert whole.columns == ["g", "id", "p"]
    assert {r.id: r.p for r in whole.collect()} == {i: p for i, (_, p) in want.items()}
    assert "rangepartitioning" not in whole._jdf.queryExecution().executedPlan().toString()
