"""Data-set construction queries (described by the task, built here on Spark)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import steps as st
from ...operators.rates import add_rate
from ...operators.sequence import running_index
from ...sources.fixtures import ITEM_KEYS, step_log, transactions
from ..oracle import ITEM_ORDER, with_steps, with_transactions
from ..registry import register
from .common import KEY_ROWS_SQL, key_rows, r, rounded, test_of, train_of, ts_sql, ts_text

ROLLUP_TIMES = ["step_start", "first_tx", "correct_tx", "step_end"]

TIME_ORDER = ["first_tx", *ITEM_KEYS]


@register("step_rollup", with_transactions(f"""
SELECT student, problem, step, {", ".join(ts_sql(c) for c in ROLLUP_TIMES)},
       dur, correct_dur, error_dur, cfa, incorrects, hints, corrects FROM (
SELECT student, problem, step,
       min(tx_time) AS step_start,
       min(tx_time) FILTER (WHERE outcome IN ('correct', 'incorrect', 'hint')) AS first_tx,
       min(tx_time) FILTER (WHERE outcome = 'correct') AS correct_tx,
       max(tx_time) AS step_end,
       round(sum(tx_dur), 9) AS dur,
       round(CASE WHEN fa = 'correct' THEN sum(tx_dur) END, 9) AS correct_dur,
       round(CASE WHEN fa IS NOT NULL AND fa <> 'correct' THEN sum(tx_dur) END, 9) AS error_dur,
       CAST(CASE WHEN fa = 'correct' THEN 1 WHEN fa IS NOT NULL THEN 0 END AS INTEGER) AS cfa,
       CAST(count(*) FILTER (WHERE outcome = 'incorrect') AS BIGINT) AS incorrects,
       CAST(count(*) FILTER (WHERE outcome = 'hint') AS BIGINT) AS hints,
       CAST(count(*) FILTER (WHERE outcome = 'correct') AS BIGINT) AS corrects
FROM transactions JOIN firsts USING (student, problem, step)
GROUP BY student, problem, step, fa)""", """
firsts AS (SELECT student, problem, step,
                  arg_min(outcome, tx_time) FILTER (WHERE outcome IN ('correct', 'incorrect', 'hint'))
                    AS fa
           FROM transactions GROUP BY student, problem, step)"""))
def step_rollup(spark, sf_dir):
    """Transactions (events) rolled up into one step record per student step."""
    out = st.step_rollup(transactions(spark, sf_dir))
    return ts_text(rounded(out, ["dur", "correct_dur", "error_dur"]), ROLLUP_TIMES)


@register("problem_view", with_steps(f"""
SELECT student, problem, step, {ts_sql("first_tx")}, problem_view FROM step_log"""))
def problem_view(spark, sf_dir):
    """Running count of each student's encounters with a problem, by time."""
    sl = step_log(spark, sf_dir, with_view=False, keep_keys=True)
    kept = ["student", "problem", "step", "first_tx"]  # the keys of the order go
    return ts_text(st.problem_views(sl, TIME_ORDER, keep=kept).select(
        *kept, "problem_view"), ["first_tx"])


@register("renumber_rows", with_steps(f"""
SELECT split, row, student, problem, step, {ts_sql("first_tx")} FROM step_log"""))
def renumber_rows(spark, sf_dir):
    """Row numbers 1..n restarted per split, in key order, via the range-sliced
    numbering (no task holds a whole split)."""
    sl = step_log(spark, sf_dir, with_view=False, keep_keys=True)
    kept = ["student", "problem", "step", "first_tx"]  # the keys of the order go
    numbered = running_index(sl, ["split"], list(ITEM_KEYS), "row", keep=kept)
    return ts_text(numbered.select("split", "row", *kept), ["first_tx"])


@register("opportunity_count", with_steps(f"""
SELECT student, problem, step, kc, {ts_sql("first_tx")},
       string_agg(CAST(n AS VARCHAR), '~~' ORDER BY pos) AS opportunity_count
FROM (
  SELECT *, dense_rank() OVER (PARTITION BY student, k ORDER BY first_tx, {ITEM_ORDER}) AS n
  FROM (SELECT *, unnest(string_split(kc, '~~')) AS k,
               generate_subscripts(string_split(kc, '~~'), 1) AS pos
        FROM step_log WHERE kc IS NOT NULL AND kc <> ''))
GROUP BY student, problem, step, kc, first_tx, {ITEM_ORDER}"""))
def opportunity_count(spark, sf_dir):
    """Opportunity numbers recomputed from the KC lists and time order."""
    sl = step_log(spark, sf_dir, with_view=False, keep_keys=True)
    ids = ["student", "problem", "step", "kc", "first_tx", *ITEM_KEYS]
    opp = st.opportunity_counts(sl, ids, TIME_ORDER)
    return ts_text(opp.select("student", "problem", "step", "kc", "first_tx", "opportunity_count"),
                   ["first_tx"])


@register("holdout_split", with_steps(f"""
SELECT student, unit, problem, step, {ts_sql("first_tx")},
       CASE WHEN problem = test_problem THEN 'test'
            WHEN first_tx < start THEN 'train' ELSE 'discard' END AS part
FROM key_rows
JOIN (SELECT student, unit, arg_min(problem, md5(student || '|' || problem)) AS test_problem
      FROM key_rows GROUP BY student, unit) t USING (student, unit)
JOIN (SELECT student, unit, problem AS test_problem, min(first_tx) AS start
      FROM key_rows GROUP BY student, unit, problem) s USING (student, unit, test_problem)""",
                                      KEY_ROWS_SQL))
def holdout_split(spark, sf_dir):
    """Per (student, unit) one hashed-random problem is test; earlier rows train."""
    rows = key_rows(spark, sf_dir)
    return ts_text(st.holdout_split(rows).select("student", "unit", "problem", "step", "first_tx",
                                                 "part"), ["first_tx"])


_MASKED = ", ".join(f"CAST(NULL AS {t}) AS {c}" for c, t in [
    ("step_start", "VARCHAR"), ("first_tx", "VARCHAR"), ("correct_tx", "VARCHAR"),
    ("step_end", "VARCHAR"), ("dur", "DOUBLE"), ("correct_dur", "DOUBLE"),
    ("error_dur", "DOUBLE"), ("incorrects", "BIGINT"), ("hints", "BIGINT"),
    ("corrects", "BIGINT")])


@register("mask_test", with_steps(f"""
SELECT split, student, hierarchy, problem, problem_view, step, {_MASKED}, cfa, kc, opportunity
FROM test"""))
def mask_test(spark, sf_dir):
    """Test rows as a test file carries them: withheld columns blank."""
    sl = step_log(spark, sf_dir, with_view=True)
    masked = st.mask_test(test_of(sl))
    return ts_text(masked.drop("truth"), ROLLUP_TIMES)


# Written from the list of the 11 columns that a challenge test file leaves empty.
_CHALLENGE = ", ".join(f"CAST(NULL AS {t}) AS {c}" for c, t in [
    ("step_start", "VARCHAR"), ("first_tx", "VARCHAR"), ("correct_tx", "VARCHAR"),
    ("step_end", "VARCHAR"), ("dur", "DOUBLE"), ("correct_dur", "DOUBLE"),
    ("error_dur", "DOUBLE"), ("cfa", "INTEGER"), ("incorrects", "BIGINT"), ("hints", "BIGINT"),
    ("corrects", "BIGINT")])


@register("mask_challenge", with_steps(f"""
SELECT split, student, hierarchy, problem, problem_view, step, {_CHALLENGE}, kc, opportunity
FROM test"""))
def mask_challenge(spark, sf_dir):
    """Test rows in the challenge form: the label is withheld as well."""
    sl = step_log(spark, sf_dir, with_view=True)
    masked = st.mask_test(test_of(sl), st.CHALLENGE_WITHHELD)
    return ts_text(masked.drop("truth"), ROLLUP_TIMES)


@register("rate_single_kc", with_steps(f"""
SELECT k AS kc_one, CAST(count(*) AS BIGINT) AS n,
       CAST(count(*) FILTER (WHERE cfa = 1) AS BIGINT) AS n_correct,
       {r("count(*) FILTER (WHERE cfa = 1) / count(*)")} AS rate
FROM (SELECT cfa, unnest(list_distinct(string_split(kc, '~~'))) AS k
      FROM train WHERE kc IS NOT NULL AND kc <> '')
GROUP BY k"""))
def rate_single_kc(spark, sf_dir):
    """Correct rate per single KC (each KC of a step counted once)."""
    train = st.explode_kcs(train_of(step_log(spark, sf_dir, with_view=False)))
    out = train.groupBy("kc_one").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.count_if(F.col("cfa") == 1).cast("bigint").alias("n_correct"))
    return rounded(out.withColumn("rate", F.col("n_correct") / F.col("n")), ["rate"])


@register("learning_curve", with_steps(f"""
SELECT opportunity, CAST(count(*) AS BIGINT) AS n,
       {r("count(*) FILTER (WHERE cfa = 1) / count(*)")} AS rate
FROM (SELECT cfa, unnest(list_transform(string_split(opportunity, '~~'),
                                        lambda x: TRY_CAST(x AS BIGINT))) AS opportunity
      FROM train WHERE opportunity IS NOT NULL AND opportunity <> '')
GROUP BY opportunity"""))
def learning_curve(spark, sf_dir):
    """Correct rate by opportunity number (practice effect)."""
    train = st.explode_opportunities(train_of(step_log(spark, sf_dir, with_view=False)))
    out = train.groupBy("opportunity").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        (F.count_if(F.col("cfa") == 1) / F.count(F.lit(1))).alias("rate"))
    return rounded(out, ["rate"])


@register("kc_variety", with_steps("""
SELECT problem, step, CAST(count(DISTINCT kc) AS BIGINT) AS n_kc FROM step_log
GROUP BY problem, step"""))
def kc_variety(spark, sf_dir):
    """Distinct KC strings per (problem, step) over all rows."""
    sl = step_log(spark, sf_dir, with_view=False)
    return sl.groupBy("problem", "step").agg(F.count_distinct("kc").cast("bigint").alias("n_kc"))


@register("rate_problem_step", with_steps(f"""
SELECT t.problem, t.step, {r("coalesce(g.v, (SELECT avg(v) FROM g))")} AS problem_step_cfar
FROM test t LEFT JOIN g ON t.problem = g.problem AND t.step = g.step""", """
g AS (SELECT problem, step, count(*) FILTER (WHERE cfa = 1) / count(*) AS v FROM train
      WHERE problem IS NOT NULL AND step IS NOT NULL GROUP BY problem, step)"""))
def rate_problem_step(spark, sf_dir):
    """Rate of the true step key (problem, step), attached to test rows."""
    sl = step_log(spark, sf_dir, with_view=False)
    out = add_rate(train_of(sl), test_of(sl), ["problem", "step"], "problem_step_cfar")
    return rounded(out.select("problem", "step", "problem_step_cfar"), ["problem_step_cfar"])


@register("record_checks", with_steps("""
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(*) FILTER (WHERE correct_dur IS NOT NULL AND cfa IS NOT NULL AND cfa <> 1) AS BIGINT)
         AS bad_correct_dur,
       CAST(count(*) FILTER (WHERE error_dur IS NOT NULL AND cfa IS NOT NULL AND cfa <> 0) AS BIGINT)
         AS bad_error_dur,
       CAST(count(*) FILTER (WHERE coalesce(len(string_split(nullif(kc, ''), '~~')), 0)
                              <> coalesce(len(string_split(nullif(opportunity, ''), '~~')), 0))
            AS BIGINT) AS bad_kc_lists
FROM step_log"""))
def record_checks(spark, sf_dir):
    """Counts of rows breaking the step-record invariants."""
    return st.record_checks(step_log(spark, sf_dir, with_view=False))
