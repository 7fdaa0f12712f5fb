"""Scoring arithmetic on deterministic stand-in predictions.

Model outputs cannot be compared with SQL, so the arithmetic that turns
predictions into scores and a submission is checked on stand-ins built from
the feature table: the student and problem rates play the forest and the
booster of the soft vote, and the four rates play the boosting estimators
of the weighted median.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.metrics import clamp01, rmse, soft_vote, weighted_median
from ...operators.sequence import running_index
from ...session import scratch_path
from ...sources import tsv
from ...sources.fixtures import step_log
from ..oracle import with_steps
from ..registry import register
from ..submission import fill_labels, mean_score
from .common import rounded
from .features import features_df, features_sql

# Soft-vote weights of the reference's vote (forest 1, booster 1.5).
VOTE_WEIGHTS = (1.0, 1.5)
VOTE_INPUTS = ("personal_cfar", "problem_cfar")
# Stand-in estimator weights for the weighted median.
MEDIAN_INPUTS = ("personal_cfar", "problem_cfar", "step_cfar", "kc_cfar")
MEDIAN_WEIGHTS = (1.0, 2.0, 3.0, 4.0)

VOTE_SQL = f"(personal_cfar * {VOTE_WEIGHTS[0]} + problem_cfar * {VOTE_WEIGHTS[1]}) / {sum(VOTE_WEIGHTS)}"


def _features(spark, sf_dir):
    return features_df(spark, sf_dir, with_row=True)


def _with_vote(ft):
    return ft.withColumn("vote", soft_vote(VOTE_INPUTS, VOTE_WEIGHTS))


@register("rmse_mean_baseline", with_steps("""
SELECT CAST(count(*) AS BIGINT) AS n,
       round(sqrt(avg(power((SELECT avg(cfa) FROM train) - cfa, 2))), 9) AS rmse
FROM test WHERE cfa IS NOT NULL"""))
def rmse_mean_baseline(spark, sf_dir):
    """RMSE of predicting the training mean label for every labelled test row."""
    steps = step_log(spark, sf_dir, with_view=False)
    mean = steps.where(F.col("split") == "train").agg(F.avg("cfa")).scalar()
    lab = steps.where((F.col("split") == "test") & F.col("cfa").isNotNull())
    out = lab.agg(F.count(F.lit(1)).cast("bigint").alias("n"), rmse(mean, "cfa").alias("rmse"))
    return rounded(out, ["rmse"])


@register("soft_vote", features_sql(f"""
SELECT row, round({VOTE_SQL}, 9) AS vote FROM features WHERE split = 'test'"""))
def soft_vote_q(spark, sf_dir):
    ft = _with_vote(_features(spark, sf_dir))
    return rounded(ft.where(F.col("split") == "test").select("row", "vote"), ["vote"])


def _wmedian_sql() -> str:
    items = ", ".join(f"{{'p': {p}, 'w': {w}}}" for p, w in zip(MEDIAN_INPUTS, MEDIAN_WEIGHTS))
    return features_sql("""
SELECT row, round(min(p), 9) AS wmedian FROM cum WHERE c >= 0.5 * t GROUP BY row""", f"""
preds AS (SELECT row, unnest([{items}], recursive := true) FROM features WHERE split = 'test')""", """
cum AS (SELECT row, p,
               sum(w) OVER (PARTITION BY row ORDER BY p, w ROWS BETWEEN UNBOUNDED PRECEDING
                            AND CURRENT ROW) AS c,
               sum(w) OVER (PARTITION BY row) AS t
        FROM preds)""")


@register("weighted_median", _wmedian_sql())
def weighted_median_q(spark, sf_dir):
    """Weighted median of four stand-in estimator outputs per test row."""
    ft = _features(spark, sf_dir).where(F.col("split") == "test")
    out = ft.select("row", weighted_median(MEDIAN_INPUTS, MEDIAN_WEIGHTS).alias("wmedian"))
    return rounded(out, ["wmedian"])


@register("submission", features_sql(f"""
SELECT row, round(coalesce(CAST(cfa AS DOUBLE), greatest(0.0, least(1.0, {VOTE_SQL}))), 9) AS cfa
FROM features WHERE split = 'test'"""))
def submission(spark, sf_dir):
    """Test rows with missing labels filled by the (stand-in) vote; known labels kept."""
    test = _with_vote(_features(spark, sf_dir)).where(F.col("split") == "test")
    filled = F.coalesce(F.col("cfa").cast("double"), clamp01("vote"))
    return rounded(test.select("row", filled.alias("cfa")), ["cfa"])


@register("mean_rmse", features_sql(f"""
SELECT CAST(count(*) AS BIGINT) AS n_sets, round(avg(rmse), 9) AS mean_rmse FROM (
  SELECT unit, sqrt(avg(power(greatest(0.0, least(1.0, {VOTE_SQL})) - cfa, 2))) AS rmse
  FROM features WHERE split = 'test' AND cfa IS NOT NULL GROUP BY unit)"""))
def mean_rmse(spark, sf_dir):
    """Mean over units (standing in for data sets) of the vote's RMSE."""
    ft = _with_vote(_features(spark, sf_dir)).where(F.col("split") == "test")
    out = mean_score(ft.select("unit", "cfa", clamp01("vote").alias("prediction")), "unit")
    return rounded(out, ["mean_rmse"])


@register("submission_order", with_steps(f"""
SELECT row AS place, row, student, coalesce(CAST(cfa AS DOUBLE), CAST({(0.25 + 0.5) / 2} AS DOUBLE)) AS label
FROM test"""))
def submission_order(spark, sf_dir):
    """The test file with its labels filled, written in its own order: the place
    of every line when the parts are read in order of their names."""
    rows = step_log(spark, sf_dir, with_row=True).where(F.col("split") == "test")
    vote = soft_vote(("a", "b"), (1.0, 1.0))
    stand_in = rows.select("row", F.lit(0.25).alias("a"), F.lit(0.5).alias("b")).select(
        "row", vote.alias("prediction"))
    filled = fill_labels(rows, stand_in)
    path = scratch_path(spark, "submission-order")
    tsv.write_ordered(filled.select(*tsv.FILE_ORDER), path)
    cell = F.split("value", "\t")
    cells = tsv.numbered_lines(spark, path).select(
        "file", "line", cell[0].alias("row"), cell[1].alias("student"),
        cell[tsv.FILE_ORDER.index("cfa")].alias("label"))  # what is returned of a line
    lines = running_index(cells, [], ["file", "line"], "place", keep=["row", "student", "label"])
    return lines.where("place > 1").select(  # the header is the first line of all
        (F.col("place") - 1).alias("place"), F.col("row").cast("bigint").alias("row"), "student",
        F.round(F.col("label").cast("double"), 9).alias("label"))
