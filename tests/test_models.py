"""Models on the smallest scale: fits beat the constant baseline, the same seed
gives the same score, incomplete rows neither stop a fit nor stay unpredicted,
known labels survive the export."""

import math
import os

import pytest
from pyspark.sql import functions as F

from kcflow.plans import models as M
from kcflow.plans.features import feature_table
from kcflow.plans.submission import export, score
from kcflow.session import scratch_path
from kcflow.sources.fixtures import step_log
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def features(spark):
    return feature_table(step_log(spark, SF_SMALL, with_row=True))


@pytest.fixture(scope="module")
def frames(features):
    data = M.model_frames(features)
    yield data
    data.release()


def rmse_of(model, frames):
    lab = frames.test.where(F.col("cfa").isNotNull())
    return score(model.predict(lab)).first()["rmse"]


def baseline(frames):
    mean = frames.fit.agg(F.avg("cfa")).first()[0]
    lab = frames.test.where(F.col("cfa").isNotNull())
    return score(lab.withColumn("prediction", F.lit(mean))).first()["rmse"]


# rounds are cut here, in the test, to keep it short; the settings are parameters
PROBABILITY = {
    "RandomForest": lambda f: M.fit("RandomForest", f),
    "XGBoost": lambda f: M.fit_booster(f, 12, **{k: v for k, v in M.XGB_LIKE.items() if k != "maxIter"}),
    "Lightgbm": lambda f: M.fit_booster(f, 12),
    "BasicLogistic": lambda f: M.fit("BasicLogistic", f),
    "Vote": lambda f: M.fit_vote(f, rounds=8),
}


@pytest.mark.parametrize("method", PROBABILITY)
def test_beats_constant(frames, method):
    assert rmse_of(PROBABILITY[method](frames.fit), frames) < baseline(frames)


def test_tree_and_adaboost_are_repeatable(frames):
    for fit in (lambda f: M.fit("DecisionTree", f), lambda f: M.fit_adaboost(f, rounds=4)):
        a, b = (rmse_of(fit(frames.fit), frames) for _ in range(2))
        assert a == pytest.approx(b, abs=1e-12) and a < 0.75


def test_settings_are_the_full_ones():
    assert M.LGBM_LIKE["maxIter"] == 2150 and M.XGB_LIKE["maxIter"] == 150
    assert M.GBDT["maxIter"] == 200 and M.ADABOOST_ROUNDS == 50 and M.CV_FOLDS == 5
    assert len(M.XGB_GRID["maxIter"]) == 30 and tuple(M.LGBM_GRID["maxIter"])[-1] == 4000


def test_null_label_and_null_input(features):
    """A training row without label is not fitted on; a test row with a missing
    input is predicted."""
    first = features.where("split = 'train'").agg(F.min("row")).first()[0]
    hole = features.where("split = 'test'").agg(F.min("row")).first()[0]
    dirty = features.withColumns({
        "cfa": F.when((F.col("split") == "train") & (F.col("row") == first), None)
        .otherwise(F.col("cfa")),
        "problem_view": F.when((F.col("split") == "test") & (F.col("row") == hole), None)
        .otherwise(F.col("problem_view"))})
    data = M.model_frames(dirty)
    n = features.where("split = 'train' AND cfa IS NOT NULL").count()
    assert data.fit.count() == n - 1
    pred = M.fit("BasicLogistic", data.fit).predict(data.test)
    assert pred.count() == features.where("split = 'test'").count()
    assert pred.where("prediction IS NULL").count() == 0
    data.release()


def test_bounded_fit_rows(features):
    data = M.model_frames(features, max_fit_rows=1000)
    assert 700 < data.fit.count() < 1300
    assert data.train.count() == features.where("split = 'train'").count()
    data.release()


def test_export_keeps_known_labels(spark):
    steps = step_log(spark, SF_SMALL, with_row=True)
    holes = steps.withColumn("problem_view", F.when(F.col("row") % 10 == 0, None)
                             .otherwise(F.col("problem_view")))
    out = export(holes, scratch_path(spark, "export-test"), method="BasicLogistic")
    test = steps.where("split = 'test'").select("row", "cfa")
    j = out.select("row", F.col("cfa").alias("filled")).join(test, "row")
    assert j.where(F.col("cfa").isNotNull() & (F.col("cfa") != F.col("filled"))).count() == 0
    assert j.where(F.col("filled").isNull()).count() == 0
    assert out.count() == test.count()


def test_large_data_mode_split(frames):
    fit_rows, held = M.split_holdout(frames.fit)
    n, a, b = frames.fit.count(), fit_rows.count(), held.count()
    assert a + b == n and 0.6 < a / n < 0.8
    assert fit_rows.join(held, "row").count() == 0
    lb = M.leaderboard(frames.fit, None, ["BasicLogistic"]).first()
    assert lb["n"] == b and 0 < lb["rmse"] < lb["rmse_mean"]


def test_grid_search_over_the_classifier(frames):
    rows = M.cross_validate(frames.fit, {"maxIter": (2, 4), "maxDepth": (2,)}, folds=2).collect()
    assert sorted((r["maxIter"], r["maxDepth"]) for r in rows) == [(2, 2.0), (4, 2.0)]
    assert all(0 < r["mse"] < 0.3 and r["rmse"] == pytest.approx(r["mse"] ** 0.5) for r in rows)


def test_staged_scores_equal_single_fits(frames):
    """One fit of the largest round count scores like a fit of each smaller one."""
    from pyspark.ml.classification import GBTClassifier

    from kcflow.functions.metrics import squared_error
    from kcflow.plans.search import staged_errors

    def fitted(rounds):
        return GBTClassifier(labelCol="cfa", maxIter=rounds, maxDepth=3, stepSize=0.3,
                             subsamplingRate=0.8, seed=33).fit(frames.fit)

    rows = frames.train.where("cfa IS NOT NULL")
    staged = staged_errors(fitted(5), rows, [1, 3, 5])
    for (n, e), rounds in zip(staged, (1, 3, 5)):
        own = fitted(rounds).transform(rows).select(
            "cfa", M.prob_one().alias("p")).agg(
                F.count("*"), F.sum(squared_error("p", "cfa"))).first()
        assert n == own[0] and e == pytest.approx(own[1])


def test_halving_ends_with_the_best_of_the_full_search(frames):
    from kcflow.plans.search import budgets

    assert budgets((80, 100, 120, 160), 4, 2) == [80, 160]
    assert budgets((2, 4, 8), 8, 2) == [2, 4, 8] and budgets((2, 4), 9, None) == [4]
    grid = {"maxIter": (2, 4, 8), "maxDepth": (1, 4), "stepSize": (0.01, 0.4)}
    full = M.cross_validate(frames.fit, grid, folds=2, scored=frames.train).collect()
    halved = M.cross_validate(frames.fit, grid, folds=2, scored=frames.train, eta=2).collect()
    assert len(full) == 12 and all(r.survived and r.budget == 8 for r in full)
    labelled = frames.train.where("cfa IS NOT NULL").count()
    assert {r.n for r in full} == {labelled}
    score = {(r.maxDepth, r.stepSize, r.maxIter): r.mse for r in full}
    assert all(r.mse == pytest.approx(score[r.maxDepth, r.stepSize, r.maxIter]) for r in halved)
    last = [r for r in halved if r.survived]
    assert len({(r.maxDepth, r.stepSize) for r in last}) == 1 and {r.maxIter for r in last} == {2, 4, 8}
    best = min(score, key=score.get)
    assert (last[0].maxDepth, last[0].stepSize) == best[:2]


def test_scores_cover_rows_outside_the_fit_sample(features):
    data = M.model_frames(features, max_fit_rows=500)
    rows = M.cross_validate(data.fit, {"maxIter": (2,)}, folds=2, scored=data.train).collect()
    assert data.fit.count() < 700
    assert rows[0]["n"] == data.train.where("cfa IS NOT NULL").count() > 2000
    board = M.leaderboard(data.fit, data.test, ["BasicLogistic"], baseline=data.train).first()
    mean = data.train.agg(F.avg("cfa")).first()[0]
    want = data.test.where("cfa IS NOT NULL").agg(
        F.sqrt(F.avg(F.pow(F.col("cfa") - mean, 2)))).first()[0]
    assert board["rmse_mean"] == pytest.approx(want)
    data.release()


def test_resampled_and_weighted_boosting(frames):
    """Both forms beat the constant, are the same on every run, and come close."""
    rows = frames.test.where("cfa IS NOT NULL")

    def error(**how):
        pred = M.fit_adaboost(frames.fit, rounds=6, **how).predict(rows)
        return pred.agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("cfa"), 2)))).first()[0]

    drawn, weighted = error(resample=True), error()
    p = rows.agg(F.avg("cfa")).first()[0]
    constant = (p * (1 - p)) ** 0.5
    assert drawn == pytest.approx(error(resample=True)) and drawn < constant and weighted < constant
    assert abs(drawn - weighted) < 0.05


def test_every_row_is_fitted_on(spark):
    """More rows than the library once sampled: a fit reads them all."""
    n = 1_100_000
    rows = spark.range(n).select(
        F.lit("train").alias("split"), F.col("id").alias("row"),
        *[(F.col("id") % 7).cast("double").alias(c) for c in M.INPUTS],
        (F.col("id") % 2).cast("int").alias("cfa"))
    data = M.model_frames(rows)
    assert data.fit.count() == n
    assert M.fit_rows(data.train).count() == n
    data.release()


def test_leaderboard_keeps_the_fit_rows_once(spark, frames):
    """The kept rows of ``model_frames`` are used as they are and stay the caller's."""
    def kept():
        return {int(i) for i in spark.sparkContext._jsc.getPersistentRDDs()}

    assert frames.fit.count() and frames.fit.is_cached
    before = kept()
    M.leaderboard(frames.fit, frames.test, ["BasicLogistic"], baseline=frames.train)
    assert frames.fit.is_cached and before <= kept()
    assert not frames.fit.storageLevel.useDisk


def test_boosted_trees_in_blocks_equal_the_columns(spark, frames):
    """The trees' outputs and their weighted median are those of MLlib's columns, and
    the weights of a round those of the step-by-step columns."""
    from pyspark.ml.regression import DecisionTreeRegressor

    from kcflow.functions.metrics import weighted_median

    rows, done, w = frames.fit.select("row", "features", "cfa"), [], F.lit(1.0)
    fitted, weights = [], [0.7, 0.2, 0.2, 0.9]
    wide = rows
    for i, depth in enumerate((3, 1, 0, 3)):
        model = DecisionTreeRegressor(maxDepth=depth, labelCol="cfa", seed=i).fit(
            frames.fit.where(F.col("row") % 4 != i))
        fitted.append(M.tree_of(model))
        wide = model.setPredictionCol(f"p{i}").transform(wide)
        top, total, beta = 0.8 + i / 10, 100.0 + i, 0.3 + i / 10
        done.append((fitted[-1], top, total, math.log(beta)))
        w = M.adaboost_weight(w / total, M.adaboost_loss(
            F.abs(F.col("cfa") - F.col(f"p{i}")), top), beta)
    got = wide.select(
        M._tree_median(fitted, weights).alias("a"),
        weighted_median([f"p{i}" for i in range(4)], weights).alias("b"),
        M._weights(done).alias("c"), w.alias("d")).collect()
    assert len(got) == frames.fit.count()
    assert all(r.a == r.b and r.c == pytest.approx(r.d, rel=1e-9) for r in got)
    assert len({r.a for r in got}) > 3


def test_boosting_writes_and_keeps_nothing(spark, frames):
    """A round's rows and weights live in memory and go with it; no round is a checkpoint."""
    before = set(spark.sparkContext._jsc.getPersistentRDDs())
    folder = spark.sparkContext.getCheckpointDir()
    written = sum(len(f) for _, _, f in os.walk(folder.removeprefix("file:")))
    fitted = M.fit_adaboost(frames.fit, rounds=11)
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= before
    assert sum(len(f) for _, _, f in os.walk(folder.removeprefix("file:"))) == written
    plan = fitted.predict(frames.test)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "array_sort" not in plan
