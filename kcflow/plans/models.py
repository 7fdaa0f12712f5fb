"""Models on the feature table: MLlib estimators, AdaBoost.R2, soft vote, CV.

Every fit is an MLlib job on the executors.  ``model_frames`` writes the
input rows once (parquet in the shared checkpoint folder), so iterative learners
do not recompute the feature plan on every pass, and keeps the fit rows in memory
as far as they fit; the others are read again from that table, so they are
not on disk twice.  ``release`` frees them.

Every complete, labelled training row is fitted on.  A caller of the library may
ask for fewer (``max_fit_rows``, picked by a hash of the row id); no query does.
Every row is predicted: a missing input is replaced by the mean of the complete
training rows.

Rounds, depths, grids and folds are parameters with the reference's settings
as defaults.

Mapping of the reference's eight methods (SURVEY section 2.8):

* ``DecisionTree``  - DecisionTreeClassifier, hard 0/1 prediction
* ``RandomForest``  - RandomForestClassifier, 50 trees, probability of 1
* ``Adaboost``      - AdaBoost.R2 (exponential loss) over depth-3 regression
                      trees, weighted fits (``resample``: fits on weighted resamples)
* ``XGBoost``       - GBTClassifier 150 x depth 5, rate 0.1, subsample 0.8
* ``Lightgbm``      - GBTClassifier 2150 x depth 4, rate 0.1, subsample 0.85
* ``GBDT``          - GBTClassifier 200 x depth 3, rate 0.1
* ``BasicLogistic`` - LogisticRegression with an L2 penalty
* ``Vote``          - soft vote of RandomForest (1) and Lightgbm (1.5)
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier,
                                       LogisticRegression, RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import rmse
from ..operators.sequence import materialize, sliced, systematic_counts
from .features import FEATURES
from .search import search

LABEL = "cfa"
INPUTS = tuple(c for c in FEATURES if c != LABEL)
SEED = 33

# The reference's model settings (see the module docstring).
FOREST = dict(numTrees=50, featureSubsetStrategy="sqrt", maxDepth=30,
              minWeightFractionPerNode=0.005, impurity="gini")
XGB_LIKE = dict(maxIter=150, maxDepth=5, stepSize=0.1, subsamplingRate=0.8)
LGBM_LIKE = dict(maxIter=2150, maxDepth=4, stepSize=0.1, subsamplingRate=0.85)
GBDT = dict(maxIter=200, maxDepth=3, stepSize=0.1)
VOTE_WEIGHTS = (1.0, 1.5)
ADABOOST_ROUNDS, ADABOOST_RATE, ADABOOST_DEPTH = 50, 1.0, 3
TREE_MAX_DEPTH = 30
# Rows per partition of the fit table: sequential learners pay per task.
FIT_ROWS_PER_PARTITION = 25_000
# Models fitted at the same time by the leaderboard (Spark interleaves their jobs).
CONCURRENT_FITS = 4


@dataclass
class Frames:
    """Assembled rows of one feature table: ``fit`` (complete, labelled
    training rows), ``train`` and ``test`` (every row)."""

    fit: DataFrame
    train: DataFrame
    test: DataFrame

    def release(self) -> None:
        self.fit.unpersist()


def bounded_sample(rows: DataFrame, n: int, most: int, id_col: str = "row") -> DataFrame:
    """At most about ``most`` of ``n`` rows, picked by a hash of the id (the
    same ones on every run); all rows when they are few enough."""
    if n <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(n)) < most)


def model_frames(features: DataFrame, max_fit_rows: int | None = None,
                 name: str = "model-input") -> Frames:
    """Split, impute and assemble a feature table for fitting and prediction."""
    others = [c for c in features.columns if c not in INPUTS]
    present = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in INPUTS]
    complete = present[0]
    for x in present[1:]:
        complete = complete & x
    plain = materialize(features.select(
        *others, *INPUTS, complete.alias("_kc_complete")), name)
    known = plain.where((F.col("split") == "train") & F.col("_kc_complete"))
    # one row with one mean per input, attached as constants
    means = known.agg(*[F.avg(c).alias(c) for c in INPUTS]).first()
    filled = plain.withColumns({c: F.coalesce(
        F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")),
        F.lit(float(means[c] if means[c] is not None else 0.0))) for c in INPUTS})
    data = VectorAssembler(inputCols=list(INPUTS), outputCol="features").transform(
        filled.withColumn(LABEL, F.col(LABEL).cast("double")))
    data = data.select(*others, "_kc_complete", "features")
    train, test = data.where(F.col("split") == "train"), data.where(F.col("split") == "test")
    return Frames(fit_rows(train, max_fit_rows), train.drop("_kc_complete"),
                  test.drop("_kc_complete"))


def fit_rows(train: DataFrame, max_fit_rows: int | None = None) -> DataFrame:
    """All complete, labelled rows (about ``max_fit_rows`` of them, if that is given)
    in few partitions, kept in memory: ``train`` comes from a written table."""
    usable = train.where(F.col(LABEL).isNotNull() & ~F.isnan(LABEL))
    if "_kc_complete" in train.columns:
        usable = usable.where(F.col("_kc_complete")).drop("_kc_complete")
    n = usable.count()
    if max_fit_rows is not None:
        usable, n = bounded_sample(usable, n, max_fit_rows), min(n, max_fit_rows)
    parts = max(1, -(-n // FIT_ROWS_PER_PARTITION))
    return usable.coalesce(parts).persist(StorageLevel.MEMORY_ONLY)


def prob_one(col: str = "probability") -> F.Column:
    return vector_to_array(F.col(col))[1]


class Fitted:
    """A fitted method: ``predict(df)`` adds a ``prediction`` column in [0, 1]."""

    def __init__(self, fn: Callable[[DataFrame], DataFrame]):
        self._fn = fn

    def predict(self, df: DataFrame) -> DataFrame:
        return self._fn(df)


def _classifier(make, use_probability: bool = True) -> Callable[[DataFrame], Fitted]:
    """``make`` builds the estimator when a session exists."""
    def fit(train: DataFrame) -> Fitted:
        model = make().setLabelCol(LABEL).setFeaturesCol("features").fit(train)

        def predict(df: DataFrame) -> DataFrame:
            out = model.transform(df)
            p = prob_one() if use_probability else F.col("prediction")
            keep = [c for c in df.columns]
            return out.select(*keep, p.cast("double").alias("_kc_pred")) \
                .withColumnRenamed("_kc_pred", "prediction")
        return Fitted(predict)
    return fit


def fit_logistic(train: DataFrame) -> Fitted:
    """L2 logistic regression; regParam 1/n matches an unscaled C = 1 penalty."""
    reg = 1.0 / max(train.count(), 1)
    return _classifier(lambda: LogisticRegression(elasticNetParam=0.0, regParam=reg,
                                                  standardization=False, maxIter=100))(train)


def adaboost_loss(error: F.Column, top: float | F.Column) -> F.Column:
    """Exponential loss of a row: 1 - exp(-error / largest error)."""
    return 1.0 - F.exp(-error / (F.lit(top) if isinstance(top, float) else top))


def adaboost_weight(weight: F.Column, loss: F.Column, beta: float | F.Column,
                    rate: float = ADABOOST_RATE) -> F.Column:
    """New weight of a row, before normalising: w * beta ** (rate * (1 - loss))."""
    return weight * F.pow(F.lit(beta) if isinstance(beta, float) else beta, rate * (1.0 - loss))


def fit_adaboost(train: DataFrame, rounds: int = ADABOOST_ROUNDS, rate: float = ADABOOST_RATE,
                 depth: int = ADABOOST_DEPTH, resample: bool = False,
                 id_col: str = "row") -> Fitted:
    """AdaBoost.R2 (Drucker 1997) with exponential loss.

    Per round, with weights w: fit a regression tree on all rows weighted by w (or,
    with ``resample``, on a sample of as many rows as there are, drawn by w with
    repeats, whose expected fit that is), e = |y - p| / max |y - p|, L = 1 - exp(-e), A = sum(w L) / sum(w); stop
    when A >= 0.5 (or the fit is perfect); b = A / (1 - A); the tree gets
    weight rate * ln(1 / b) and w becomes w * b^(rate (1 - L)).  The prediction
    is the weighted median of the trees' outputs.

    A sample is systematic (``sequence.systematic_counts``): rows are put in order of
    a hash of their id once, and every round draws along the running sums of its
    weights from a start of its own.  A row drawn k times is one row of weight k.

    The weights of a round follow from the rounds before it, so a round computes them
    from the fit rows and keeps rows and weights in memory while it lasts (``_weights``):
    nothing is written, no round reads another one's rows, and rows that do
    not fit in memory are made again.  The loss sums and the largest error are
    aggregates.  Weights are scaled by the sum that the round has measured anyway;
    only their ratios matter to the tree and to A.
    """
    kept = ["features", LABEL]
    n = 0
    base = train.select(*kept)
    if resample:
        n = train.count()
        order = F.xxhash64(F.lit(SEED), id_col)
        parts = max(1, -(-n // FIT_ROWS_PER_PARTITION))
        base = sliced(train.select(id_col, *kept), [order, F.col(id_col)], parts, kept)
    models, alphas, rounds_done = [], [], []
    for t in range(rounds):
        cur = base.withColumn("w", _weights(rounds_done)).persist(StorageLevel.MEMORY_ONLY)
        cur.count()  # by all tasks at once: the fit would first take one row, from one task
        sample, weight = cur, "w"
        if resample:
            start = random.Random(SEED + t).random()
            # read by each pass of the fit
            sample = systematic_counts(cur, "w", n, "drawn", start).where("drawn > 0").select(
                "features", LABEL, "drawn").persist(StorageLevel.MEMORY_AND_DISK)
            weight = "drawn"
        tree = DecisionTreeRegressor(maxDepth=depth, labelCol=LABEL, featuresCol="features",
                                     weightCol=weight, seed=SEED + t).fit(sample)
        if resample:
            sample.unpersist()
        scored = tree.transform(cur).withColumn("err", F.abs(F.col(LABEL) - F.col("prediction")))
        # one pass: a tree has few leaves and the label few values, so few errors differ
        weighed = scored.groupBy("err").agg(F.sum("w").alias("w"))
        sized = weighed.crossJoin(F.broadcast(weighed.agg(F.max("err").alias("top"))))  # one row
        top, total, lost = sized.agg(F.max("top"), F.sum("w"), F.sum(F.col("w") * adaboost_loss(
            F.col("err"), F.nullif(F.col("top"), F.lit(0.0))))).first()
        cur.unpersist()
        top = float(top or 0.0)
        if top <= 0.0:
            models.append(tree_of(tree))
            alphas.append(1.0)
            break
        average = lost / total
        if average >= 0.5:
            if not models:
                models.append(tree_of(tree))
                alphas.append(1.0)
            break
        beta = average / (1.0 - average)
        models.append(tree_of(tree))
        alphas.append(rate * math.log(1.0 / beta))
        rounds_done.append((models[-1], top, total, rate * math.log(beta)))

    def predict(df: DataFrame) -> DataFrame:
        return df.select(*df.columns, _tree_median(models, alphas).alias("prediction"))
    return Fitted(predict)


def tree_of(model: DecisionTreeRegressionModel) -> tuple | float:
    """A fitted tree as (input, threshold, left, right) down to the values of its leaves."""
    def node(n) -> tuple | float:
        if n.getClass().getSimpleName() == "LeafNode":
            return float(n.prediction())
        split = n.split()
        if split.getClass().getSimpleName() != "ContinuousSplit":
            raise ValueError("the inputs of a boosted tree are numbers")
        return split.featureIndex(), float(split.threshold()), node(n.leftChild()), \
            node(n.rightChild())
    return node(model._java_obj.rootNode())


def tree_values(tree: tuple | float, x: np.ndarray) -> np.ndarray | float:
    """The tree's output for each column of ``x`` (a row per input)."""
    if not isinstance(tree, tuple):
        return tree
    at, threshold, left, right = tree
    return np.where(x[at] <= threshold, tree_values(left, x), tree_values(right, x))


def _inputs(x: pa.Array) -> np.ndarray:
    """A row per input, a column per vector."""
    flat = x.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(len(x), -1).T)


def _weights(done: Sequence[tuple]) -> F.Column:
    """The weight of a row after the given rounds (tree, largest error, sum of weights,
    rate * ln beta): the product of ``adaboost_weight``, as a sum of logarithms."""
    if not done:
        return F.lit(1.0)
    done = list(done)

    @F.arrow_udf("double")
    def weights(x: pa.Array, y: pa.Array) -> pa.Array:
        x, y = _inputs(x), y.to_numpy(zero_copy_only=False)
        log = np.zeros(len(y))
        for tree, top, total, power in done:
            log += power * np.exp(-np.abs(y - tree_values(tree, x)) / top) - math.log(total)
        return pa.array(np.exp(log))

    return weights(vector_to_array("features"), F.col(LABEL))


def _tree_median(trees: Sequence, weights: Sequence[float]) -> F.Column:
    """``metrics.weighted_median`` of the trees' outputs, for blocks of rows."""
    # in order of the weights, so that equal outputs are in the order of that function
    order = sorted(range(len(trees)), key=lambda i: weights[i])
    trees, w = [trees[i] for i in order], np.array([weights[i] for i in order], np.float64)

    @F.arrow_udf("double")
    def median(x: pa.Array) -> pa.Array:
        n, x = len(x), _inputs(x)
        found = np.empty((n, len(trees)))
        for i, tree in enumerate(trees):
            found[:, i] = tree_values(tree, x)
        at = np.argsort(found, axis=1, kind="stable")
        upto = np.cumsum(w[at], axis=1)
        first = (upto >= upto[:, -1:] * 0.5).argmax(axis=1)
        rows = np.arange(n)
        return pa.array(found[rows, at[rows, first]])

    return median(vector_to_array("features"))


def fit_booster(train: DataFrame, rounds: int | None = None, **settings) -> Fitted:
    """A gradient-boosted classifier; LGBM_LIKE settings unless told otherwise."""
    chosen = {**LGBM_LIKE, **settings}
    if rounds is not None:
        chosen["maxIter"] = rounds
    return _classifier(lambda: GBTClassifier(seed=SEED, **chosen))(train)


def fit_vote(train: DataFrame, forest: Fitted | None = None, boost: Fitted | None = None,
             rounds: int | None = None) -> Fitted:
    """Soft vote: forest weight 1, the depth-4 booster weight 1.5.

    Already fitted members (same settings and seeds) can be passed in;
    ``rounds`` is the booster's (2150 by default)."""
    forest = forest or METHODS["RandomForest"](train)
    boost = boost or fit_booster(train, rounds)
    w1, w2 = VOTE_WEIGHTS

    def predict(df: DataFrame) -> DataFrame:
        a = forest.predict(df).withColumnRenamed("prediction", "_kc_a")
        b = boost.predict(a).withColumnRenamed("prediction", "_kc_b")
        p = (F.col("_kc_a") * w1 + F.col("_kc_b") * w2) / (w1 + w2)
        return b.select(*df.columns, p.alias("prediction"))
    return Fitted(predict)


METHODS: dict[str, Callable[[DataFrame], Fitted]] = {
    "DecisionTree": _classifier(lambda: DecisionTreeClassifier(maxDepth=TREE_MAX_DEPTH, seed=SEED),
                                use_probability=False),
    "RandomForest": _classifier(lambda: RandomForestClassifier(seed=SEED, **FOREST)),
    "Adaboost": fit_adaboost,
    "XGBoost": lambda train: fit_booster(train, **XGB_LIKE),
    "Lightgbm": fit_booster,
    "GBDT": lambda train: fit_booster(train, **{"subsamplingRate": 1.0, **GBDT}),
    "BasicLogistic": fit_logistic,
    "Vote": fit_vote,
}


def fit(method: str, train: DataFrame) -> Fitted:
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; one of {sorted(METHODS)}")
    return METHODS[method](train)


# The large-data mode holds out 30 % of the training rows.
FIT_BUCKETS, ALL_BUCKETS = 7, 10


def hash_bucket(id_col: str = "row") -> F.Column:
    """0..9 from the md5 of the row id: a split that is the same on every run."""
    return F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10) \
        .cast("bigint") % ALL_BUCKETS


def split_holdout(train: DataFrame, id_col: str = "row") -> tuple[DataFrame, DataFrame]:
    """70 / 30 split of the training rows by hash (the large-data mode, where
    test labels are withheld)."""
    b = hash_bucket(id_col)
    return train.where(b < FIT_BUCKETS), train.where(b >= FIT_BUCKETS)


def leaderboard(train: DataFrame, test: DataFrame | None, methods: Sequence[str],
                max_fit_rows: int | None = None, concurrent: int = CONCURRENT_FITS,
                baseline: DataFrame | None = None) -> DataFrame:
    """RMSE of each method on labelled held-out rows: (model, n, rmse, rmse_mean).

    ``rmse_mean`` is the score of predicting the mean label of all labelled
    ``baseline`` rows (``train`` if not given: when that is a bounded sample, pass
    all training rows).  With ``test`` None the training rows are split
    70 / 30 by hash first, the baseline's with them.  The fits share
    one table, kept once (the ``fit`` rows of ``model_frames`` are kept already), and run ``concurrent`` at a time; the vote reuses the
    forest and the booster.
    """
    if test is None:
        train, test = split_holdout(train)
        baseline = None if baseline is None else split_holdout(baseline)[0]
    kept = train.is_cached and max_fit_rows is None
    rows = train.where(F.col(LABEL).isNotNull() & ~F.isnan(LABEL)) if kept else fit_rows(
        train, max_fit_rows)
    labelled = test.where(F.col(LABEL).isNotNull() & ~F.isnan(LABEL))
    known = train if baseline is None else baseline
    mean = known.where(F.col(LABEL).isNotNull() & ~F.isnan(LABEL)).agg(F.avg(LABEL)).first()[0]
    try:
        alone = [m for m in methods if m != "Vote"]
        with ThreadPoolExecutor(max_workers=concurrent) as pool:
            fitted = dict(zip(alone, pool.map(lambda m: fit(m, rows), alone), strict=True))
        if "Vote" in methods:
            fitted["Vote"] = fit_vote(rows, fitted.get("RandomForest"), fitted.get("Lightgbm"))

        def scored(m: str) -> tuple:
            got = fitted[m].predict(labelled).agg(
                F.count(F.lit(1)).alias("n"), rmse("prediction", LABEL).alias("rmse"),
                rmse(F.lit(mean), LABEL).alias("rmse_mean")).first()
            return m, *got

        with ThreadPoolExecutor(max_workers=concurrent) as pool:
            scores = list(pool.map(scored, methods))  # one row per method
    finally:
        if not kept:
            rows.unpersist()
    return train.sparkSession.createDataFrame(
        scores, "model string, n bigint, rmse double, rmse_mean double")


# The searched settings of the two boosters (some have no MLlib counterpart).
XGB_GRID = {"maxIter": range(80, 200, 4), "maxDepth": range(2, 15),
            "stepSize": [0.01 + i * 1.99 / 19 for i in range(20)],
            "subsamplingRate": [0.7 + i * 0.2 / 19 for i in range(20)]}
LGBM_GRID = {"maxIter": (50, 1366, 2683, 4000), "maxDepth": range(2, 15, 5),
             "stepSize": (0.01, 2.0), "subsamplingRate": (0.7, 0.9)}
CV_FOLDS = 5


def cross_validate(train: DataFrame, grid: dict[str, Iterable], base: dict | None = None,
                   folds: int = CV_FOLDS, parallelism: int = CONCURRENT_FITS,
                   scored: DataFrame | None = None, eta: float | None = None) -> DataFrame:
    """Cross-validated grid search over the boosted classifier (``search.search``).

    ``grid`` maps parameters of the booster to their values (``XGB_GRID`` and
    ``LGBM_GRID`` are the reference's ranges, many thousands of cells); ``base``
    holds the settings that stay fixed.  ``train`` holds the rows to fit on,
    ``scored`` those whose errors count (all labelled training rows; ``train`` if
    not given).  ``eta`` turns the full product into successive halving.
    """
    return search(train, scored if scored is not None else train, grid, base, folds, eta,
                  parallelism, SEED, LABEL)
