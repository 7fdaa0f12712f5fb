"""Model queries and the SQL-checkable pieces around them.

Fits are iterative and have no SQL form, but what must hold of their output
has: one row per test row, known labels unchanged, every prediction present
and in [0, 1].  The queries return exactly that, so each has a twin.  The
2150-round booster and the vote that contains it take longer than a query
run allows (a round is a few Spark jobs); they are library calls
(`models.fit_booster`, `models.fit_vote`) and not registered.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.metrics import soft_vote
from ...operators.sequence import materialize, sliced, systematic_counts
from ...session import scratch_path
from ...sources.fixtures import step_log
from .. import models as M
from ..oracle import with_steps
from ..registry import register
from ..submission import export
from .common import rounded
from .features import INPUT_FEATURES, features_df, features_sql

# 70 / 30 split of the training rows when no test file exists.
FIT_SHARE = M.FIT_BUCKETS  # out of 10 hash buckets


def _frames(spark, sf_dir):
    return M.model_frames(features_df(spark, sf_dir, with_row=True))


def _valid(col: str = "prediction"):
    return F.coalesce(F.col(col).between(0.0, 1.0), F.lit(False))


def _make_model_query(method: str):
    def q(spark, sf_dir):
        frames = _frames(spark, sf_dir)
        pred = M.fit(method, frames.fit).predict(frames.test)
        frames.release()
        return pred.select("row", "cfa", _valid().alias("valid"))
    q.__name__ = f"model_{method.lower()}"
    q.__doc__ = f"Fit {method} on the training rows, predict every test row."
    return q


MODEL_KEYS = {"model_tree": "DecisionTree", "model_forest": "RandomForest",
              "model_adaboost": "Adaboost", "model_gbt_deep": "XGBoost", "model_gbt": "GBDT",
              "model_logistic": "BasicLogistic"}

MODEL_SQL = with_steps("SELECT row, CAST(cfa AS DOUBLE) AS cfa, TRUE AS valid FROM test")

for _key, _method in MODEL_KEYS.items():
    register(_key, MODEL_SQL)(_make_model_query(_method))

LEADERBOARD = tuple(MODEL_KEYS.values())


@register("model_leaderboard", with_steps(f"""
SELECT m.model, CAST(count(*) AS BIGINT) AS n,
       round(sqrt(avg(power((SELECT avg(cfa) FROM train) - cfa, 2))), 9) AS rmse_mean,
       TRUE AS scored
FROM test, (SELECT unnest({list(LEADERBOARD)}) AS model) m
WHERE cfa IS NOT NULL GROUP BY m.model"""))
def model_leaderboard(spark, sf_dir):
    """Labelled test rows scored per method, the RMSE of the training mean, and that
    each method has an RMSE."""
    frames = _frames(spark, sf_dir)
    board = M.leaderboard(frames.fit, frames.test, LEADERBOARD, baseline=frames.train)
    frames.release()
    return rounded(board.select("model", "n", "rmse_mean", _valid("rmse").alias("scored")),
                   ["rmse_mean"])


# The searched cells of the queries: all four parameters, from the reference's
# ranges but for the rounds (80 to 196 there; a round takes some 0.2 s at sf0.01, and each
# cell is fitted once per fold).
CV_GRID = {"maxIter": (3, 6, 12), "maxDepth": (2, 5), "stepSize": (0.1, 0.5),
           "subsamplingRate": (0.7, 0.9)}


@register("model_cv", with_steps(f"""
SELECT CAST(d AS DOUBLE) AS "maxDepth", CAST(s AS DOUBLE) AS "stepSize",
       CAST(r AS DOUBLE) AS "subsamplingRate", i AS "maxIter",
       (SELECT count(*) FROM train WHERE cfa IS NOT NULL) AS n, TRUE AS scored,
       TRUE AS below_constant
FROM (SELECT unnest({list(CV_GRID["maxDepth"])}) AS d),
     (SELECT unnest({list(CV_GRID["stepSize"])}) AS s),
     (SELECT unnest({list(CV_GRID["subsamplingRate"])}) AS r),
     (SELECT unnest({list(CV_GRID["maxIter"])}) AS i)"""))
def model_cv(spark, sf_dir):
    """Every cell of the grid, cross-validated over all labelled training rows: rows
    scored, and that the error is one and below that of the constant mean."""
    frames = _frames(spark, sf_dir)
    out = M.cross_validate(frames.fit, CV_GRID, scored=frames.train)
    p = frames.train.agg(F.avg("cfa")).first()[0]
    frames.release()
    return out.select("maxDepth", "stepSize", "subsamplingRate", "maxIter", "n",
                      _valid("mse").alias("scored"),
                      (F.col("mse") < p * (1 - p)).alias("below_constant"))


# Halving 4 cells over the three round counts: (rounds scored, rounds of the fit, cells).
SEARCH_GRID = {**CV_GRID, "subsamplingRate": (0.8,)}
HALVED = ((3, 3, 2), (3, 6, 1), (6, 6, 1), (3, 12, 1), (6, 12, 1), (12, 12, 1))


@register("model_search", with_steps(f"""
SELECT i AS "maxIter", b AS budget, CAST(c AS BIGINT) AS cells,
       (SELECT count(*) FROM train WHERE cfa IS NOT NULL) AS n, b = 12 AS survived,
       TRUE AS below_constant
FROM (VALUES {", ".join(map(str, HALVED))}) t(i, b, c)"""))
def model_search(spark, sf_dir):
    """A grid by successive halving: cells by the rounds they were scored at and
    given, rows scored, and that the errors are below that of the constant mean."""
    frames = _frames(spark, sf_dir)
    out = M.cross_validate(frames.fit, SEARCH_GRID, scored=frames.train, eta=2)
    p = frames.train.agg(F.avg("cfa")).first()[0]
    frames.release()
    return out.groupBy("maxIter", "budget").agg(
        F.count(F.lit(1)).alias("cells"), F.max("n").alias("n"),
        F.every("survived").alias("survived"),
        (F.max("mse") < p * (1 - p)).alias("below_constant"))


@register("submission_export", with_steps("""
SELECT row, student, problem, step, CAST(cfa AS DOUBLE) AS known, TRUE AS valid FROM test"""))
def submission_export(spark, sf_dir):
    """Fit, predict every test row, fill missing labels, write TSV, read it back:
    known labels as they were, and every label in [0, 1]."""
    steps = step_log(spark, sf_dir, with_row=True)
    written = export(steps, scratch_path(spark, "submission"), method="RandomForest")
    given = steps.where(F.col("split") == "test").select("row", F.col("cfa").alias("given"))
    return written.join(given, "row").select(
        "row", "student", "problem", "step",
        F.when(F.col("given").isNotNull(), F.col("cfa")).alias("known"), _valid("cfa").alias("valid"))


HASH_BUCKET_SQL = "CAST(('0x' || substr(md5(CAST(row AS VARCHAR)), 1, 8)) AS BIGINT) % 10"


@register("hash_split", with_steps(f"""
SELECT row, CASE WHEN {HASH_BUCKET_SQL} < {FIT_SHARE} THEN 'fit' ELSE 'holdout' END AS part
FROM train"""))
def hash_split(spark, sf_dir):
    """Deterministic 70/30 split of the training rows by a hash of the row id."""
    rows = step_log(spark, sf_dir, with_row=True).where(F.col("split") == "train")
    return rows.select("row", F.when(M.hash_bucket("row") < FIT_SHARE, "fit")
                       .otherwise("holdout").alias("part"))


_complete = " AND ".join(f"{c} IS NOT NULL" for c in INPUT_FEATURES + ("cfa",))


@register("complete_rows", features_sql(f"""
SELECT split, CAST(count(*) AS BIGINT) AS n FROM features WHERE {_complete} GROUP BY split"""))
def complete_rows(spark, sf_dir):
    """Rows left after dropping any row with a missing feature or label, per split."""
    ft = features_df(spark, sf_dir, with_row=False)
    kept = ft.na.drop("any", subset=list(INPUT_FEATURES) + ["cfa"])
    return kept.groupBy("split").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


# Weights of the resampled rows, from the row number: whole numbers, so that their sums are exact.
RESAMPLE_WEIGHT, RESAMPLE_START = "1 + row % 7 * (row % 3)", 0.25


@register("weighted_resample", with_steps(f"""
SELECT row, w, CAST(ceil(upto * n / total - {RESAMPLE_START})
                    - ceil((upto - w) * n / total - {RESAMPLE_START}) AS BIGINT) AS drawn
FROM (SELECT row, CAST({RESAMPLE_WEIGHT} AS DOUBLE) AS w,
             sum(CAST({RESAMPLE_WEIGHT} AS DOUBLE)) OVER (ORDER BY row) AS upto,
             sum(CAST({RESAMPLE_WEIGHT} AS DOUBLE)) OVER () AS total, count(*) OVER () AS n
      FROM train)"""))
def weighted_resample(spark, sf_dir):
    """How often every training row is drawn by its weight, as many draws as rows."""
    rows = step_log(spark, sf_dir, with_row=True).where(F.col("split") == "train").select(
        "row", F.expr(RESAMPLE_WEIGHT).cast("double").alias("w"))
    ranged = sliced(rows, [F.col("row")])
    drawn = systematic_counts(ranged, "w", ranged.count(), "drawn", RESAMPLE_START)
    return drawn.select("row", "w", "drawn")


# One boosting round on a stand-in tree: the mean of two rates is its prediction.
ROUND_ROWS = "split = 'train' AND cfa IS NOT NULL"


@register("adaboost_round", features_sql("""
SELECT row, round(err, 9) AS err, round(loss, 9) AS loss, round(beta, 9) AS beta,
       round(power(beta, 1 - loss) / (SELECT count(*) FROM errors), 12) AS w
FROM losses, (SELECT avg(loss) / (1 - avg(loss)) AS beta FROM losses)""", f"""
errors AS (SELECT row, abs(cfa - (personal_cfar + problem_cfar) / 2) AS err
           FROM features WHERE {ROUND_ROWS})""", """
losses AS (SELECT row, err, 1 - exp(-err / (SELECT max(err) FROM errors)) AS loss FROM errors)"""))
def adaboost_round(spark, sf_dir):
    """Error, loss, beta and new weights of one AdaBoost.R2 round (equal weights before)."""
    # read three times: for the largest error, for the mean loss and for the weights
    rows = materialize(features_df(spark, sf_dir).where(ROUND_ROWS).select(
        "row", F.abs(F.col("cfa") - soft_vote(("personal_cfar", "problem_cfar"), (1.0, 1.0)))
        .alias("err")), "round-errors")
    sized = rows.crossJoin(F.broadcast(rows.agg(  # one row
        F.max("err").alias("top"), F.count(F.lit(1)).alias("n"))))
    losses = sized.withColumn("loss", M.adaboost_loss(F.col("err"), F.col("top")))
    beta = losses.agg(F.avg("loss").alias("a")).select((F.col("a") / (1 - F.col("a"))).alias("beta"))
    out = losses.crossJoin(F.broadcast(beta))  # one row
    w = M.adaboost_weight(1 / F.col("n"), F.col("loss"), F.col("beta"))
    return rounded(rounded(out.select("row", "err", "loss", "beta", w.alias("w")),
                           ["err", "loss", "beta"]), ["w"], 12)
