"""Exploration queries: counts, describe, medians, histograms, CDF, top-k, correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import explore
from ...session import scratch_path
from ...sources import sketch_store
from ...sources.fixtures import step_log
from ..oracle import with_steps
from ..registry import register
from .common import rounded, train_of, ts_sql, ts_text
from .features import features_df, features_sql

# Fixed values of the notebook's charts: 100 bins on [0, 100] for durations,
# 15 bins on [0, 25] for per-problem medians; top and bottom 5 problems.
DURATION_BINS, DURATION_RANGE = 100, (0.0, 100.0)
MEDIAN_BINS, MEDIAN_RANGE = 15, (0.0, 25.0)
TOP_K = 5
PREVIEW_ROWS = 105
# The 12 columns of the correlation matrix, in the notebook's order.
CORR_COLUMNS = ("personal_cfar", "problem_cfar", "student", "unit", "section", "step",
                "problem", "problem_view", "cfa", "kc_num", "step_cfar", "kc_cfar")


def _train(spark, sf_dir):
    return train_of(step_log(spark, sf_dir, with_view=False))


@register("distinct_entities", with_steps("""
SELECT CAST(count(DISTINCT student) AS BIGINT) AS n_student,
       CAST(count(DISTINCT problem) AS BIGINT) AS n_problem,
       CAST(count(DISTINCT step) AS BIGINT) AS n_step,
       CAST(count(DISTINCT kc) AS BIGINT) AS n_kc
FROM train"""))
def distinct_entities(spark, sf_dir):
    return explore.distinct_counts(_train(spark, sf_dir), ["student", "problem", "step", "kc"])


SKETCH_COLUMNS = ("student", "problem", "step", "kc")
SKETCH_PARTS = 4

_exact_sql = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", part, CAST(count(DISTINCT {c}) AS BIGINT) AS n_exact, "
    f"CAST(count({c}) AS BIGINT) AS n FROM parted GROUP BY GROUPING SETS ((part), ())"
    for c in SKETCH_COLUMNS)


@register("distinct_sketches", with_steps(
    'SELECT coalesce(part, \'all\') AS part, "column", n, n_exact, TRUE AS within_error '
    f"FROM ({_exact_sql})", f"""
parted AS (SELECT *, CAST("row" % {SKETCH_PARTS} AS VARCHAR) AS part FROM train)"""))
def distinct_sketches(spark, sf_dir):
    """Distinct counts per file and over all files from stored sketches, each held
    against the exact count and the stated error."""
    path = scratch_path(spark, "sketches")
    rows = train_of(step_log(spark, sf_dir, with_row=True, with_view=False)).select(
        *SKETCH_COLUMNS, (F.col("row") % SKETCH_PARTS).cast("string").alias("part"))
    for k in range(SKETCH_PARTS):  # files that arrive one after the other
        sketch_store.add(path, rows.where(F.col("part") == str(k)), SKETCH_COLUMNS, "part")
    stored = sketch_store.load(spark, path)
    all_parts = stored.withColumn("part", F.lit("all"))
    estimated = sketch_store.counts(stored.unionByName(all_parts), ["part"])
    totals = stored.unionByName(all_parts).groupBy("part", "column").agg(F.sum("n").alias("n"))
    exact = rows.unionByName(rows.withColumn("part", F.lit("all"))).groupBy("part").agg(
        *[F.count_distinct(c).alias(c) for c in SKETCH_COLUMNS]).unpivot(
            ["part"], list(SKETCH_COLUMNS), "column", "n_exact")
    return estimated.join(totals, ["part", "column"]).join(exact, ["part", "column"]).select(
        "part", "column", "n", "n_exact",
        sketch_store.within(F.col("n_distinct"), F.col("n_exact")).alias("within_error"))


@register("describe_duration", with_steps("""
SELECT CAST(count(correct_dur) AS BIGINT) AS count, round(avg(correct_dur), 6) AS mean,
       round(stddev_samp(correct_dur), 6) AS std, min(correct_dur) AS min,
       round(quantile_cont(correct_dur, 0.25), 6) AS p25,
       round(quantile_cont(correct_dur, 0.5), 6) AS p50,
       round(quantile_cont(correct_dur, 0.75), 6) AS p75, max(correct_dur) AS max
FROM train WHERE correct_dur IS NOT NULL"""))
def describe_duration(spark, sf_dir):
    """pandas-style describe of the correct step duration (training rows)."""
    d = explore.describe(_train(spark, sf_dir), "correct_dur")
    return rounded(d, ["mean", "std", "p25", "p50", "p75"], 6)


MEDIAN_CTE = """
medians AS (SELECT problem, median(correct_dur) AS median FROM train
            WHERE correct_dur IS NOT NULL GROUP BY problem)"""


def _medians(spark, sf_dir):
    return explore.group_median(_train(spark, sf_dir), "problem", "correct_dur")


@register("problem_median", with_steps("SELECT problem, round(median, 9) AS median FROM medians",
                                       MEDIAN_CTE))
def problem_median(spark, sf_dir):
    """Exact median correct duration per problem (problems without one left out)."""
    return rounded(_medians(spark, sf_dir), ["median"])


@register("hardest_problems", with_steps(f"""
SELECT problem, round(median, 9) AS median FROM medians
ORDER BY median DESC, problem ASC LIMIT {TOP_K}""", MEDIAN_CTE))
def hardest_problems(spark, sf_dir):
    top = explore.top_k(_medians(spark, sf_dir), TOP_K, [F.desc("median"), F.asc("problem")])
    return rounded(top, ["median"])


@register("easiest_problems", with_steps(f"""
SELECT problem, round(median, 9) AS median FROM medians
ORDER BY median ASC, problem DESC LIMIT {TOP_K}""", MEDIAN_CTE))
def easiest_problems(spark, sf_dir):
    """The last five of the list sorted by descending median."""
    last = explore.top_k(_medians(spark, sf_dir), TOP_K, [F.asc("median"), F.desc("problem")])
    return rounded(last.orderBy(F.desc("median"), F.asc("problem")), ["median"])


def _hist_sql(source: str, col: str, bins: int, lo: float, hi: float, cdf: bool = False) -> str:
    width = (hi - lo) / bins
    # literals as DOUBLE, as in Spark (DuckDB would make them DECIMAL)
    LO, W, B, SPAN = (f"CAST({v!r} AS DOUBLE)" for v in (lo, width, float(bins), hi - lo))
    idx = f"CAST(least(floor(({col} - {LO}) * {B} / {SPAN}), {bins - 1}) AS BIGINT)"
    body = f"""
SELECT s.bin, {LO} + s.bin * {W} AS lo, {LO} + (s.bin + 1) * {W} AS hi,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n,
       coalesce(c.n, 0) / ((SELECT sum(n) FROM counts) * {W}) AS density
FROM (SELECT range AS bin FROM range({bins})) s LEFT JOIN counts c ON s.bin = c.bin"""
    counts = f"""
counts AS (SELECT {idx} AS bin, count(*) AS n FROM {source}
           WHERE {col} IS NOT NULL AND {col} >= {LO} AND {col} <= CAST({hi!r} AS DOUBLE)
           GROUP BY 1)"""
    if not cdf:
        return f"SELECT bin, lo, hi, n, round(density, 9) AS density FROM ({body})", counts
    return (f"""SELECT bin, hi, round(sum(density) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED
PRECEDING AND CURRENT ROW) * {W}, 9) AS cdf FROM ({body})""", counts)


def _duration_hist(spark, sf_dir):
    lo, hi = DURATION_RANGE
    return explore.histogram(_train(spark, sf_dir), "correct_dur", DURATION_BINS, lo, hi)


_b, _c = _hist_sql("train", "correct_dur", DURATION_BINS, *DURATION_RANGE)


@register("duration_histogram", with_steps(_b, _c))
def duration_histogram(spark, sf_dir):
    """Density of correct durations, 100 bins on [0, 100]."""
    return rounded(_duration_hist(spark, sf_dir), ["density"])


_b, _c = _hist_sql("train", "correct_dur", DURATION_BINS, *DURATION_RANGE, cdf=True)


@register("duration_cdf", with_steps(_b, _c))
def duration_cdf(spark, sf_dir):
    """Cumulative fraction of correct durations at the right edge of each bin."""
    width = (DURATION_RANGE[1] - DURATION_RANGE[0]) / DURATION_BINS
    return rounded(explore.cumulative(_duration_hist(spark, sf_dir), width=width), ["cdf"])


_b, _c = _hist_sql("medians", "median", MEDIAN_BINS, *MEDIAN_RANGE)


@register("median_histogram", with_steps(_b, MEDIAN_CTE, _c))
def median_histogram(spark, sf_dir):
    """Density of per-problem medians, 15 bins on [0, 25]."""
    lo, hi = MEDIAN_RANGE
    h = explore.histogram(_medians(spark, sf_dir), "median", MEDIAN_BINS, lo, hi)
    return rounded(h, ["density"])


def _corr_sql() -> str:
    """Written from the definition: DuckDB's corr skips rows where either is null."""
    items = [f"{{'col_a': '{a}', 'col_b': '{b}', 'corr': "
             f"round(CASE WHEN NOT isnan(corr({a}, {b})) THEN corr({a}, {b}) END, 6)}}"
             for a in CORR_COLUMNS for b in CORR_COLUMNS]
    return features_sql(f"""
SELECT split, unnest([{', '.join(items)}], recursive := true) FROM features GROUP BY split""")


@register("feature_correlation", _corr_sql())
def feature_correlation(spark, sf_dir):
    """Pearson correlation matrix of the 12 notebook features, for the training
    rows and for the test rows (where some labels are missing)."""
    ft = features_df(spark, sf_dir, with_row=False)
    return rounded(explore.correlation_long(ft, CORR_COLUMNS, ["split"]), ["corr"], 6)


_TIMES = ["step_start", "first_tx", "correct_tx", "step_end"]


@register("preview", with_steps(f"""
SELECT * EXCLUDE (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                  step_start, first_tx, correct_tx, step_end),
       {", ".join(ts_sql(c) for c in _TIMES)}
FROM train ORDER BY row LIMIT {PREVIEW_ROWS}"""))
def preview(spark, sf_dir):
    """First 105 training rows in file order (the notebook's head)."""
    sl = step_log(spark, sf_dir, with_view=True, with_row=True)
    return ts_text(sl.where(F.col("split") == "train").orderBy("row").limit(PREVIEW_ROWS), _TIMES)
