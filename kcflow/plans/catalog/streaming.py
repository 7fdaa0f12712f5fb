"""The step roll-up run as a Structured Streaming job."""

from __future__ import annotations

from ...streaming.closed_steps import run_closed_steps
from ...streaming.rollup import run_rollup
from ..oracle import with_transactions
from ..registry import ORACLE, register
from .common import rounded, ts_sql, ts_text
from .dataset import ROLLUP_TIMES


@register("step_rollup_stream", ORACLE["step_rollup"])
def step_rollup_stream(spark, sf_dir):
    """Events read as a stream and rolled up incrementally into step records;
    the drained result equals the batch roll-up."""
    out = run_rollup(spark, sf_dir)
    return ts_text(rounded(out, ["dur", "correct_dur", "error_dur"]), ROLLUP_TIMES)


@register("closed_steps_stream", with_transactions(f"""
SELECT student, problem, step, {", ".join(ts_sql(c) for c in ROLLUP_TIMES)},
       round(dur, 9) AS dur, round(CASE WHEN cfa = 1 THEN dur END, 9) AS correct_dur,
       round(CASE WHEN cfa = 0 THEN dur END, 9) AS error_dur, cfa, incorrects, hints, corrects,
       CAST(row_number() OVER (PARTITION BY student, problem ORDER BY step_end, step_start, step)
            AS BIGINT) AS problem_view
FROM visits
WHERE step_end + INTERVAL 2 DAY <=
      (SELECT date_trunc('milliseconds', max(tx_time)) - INTERVAL 1 DAY FROM transactions)""", """
paused AS (
  SELECT *, coalesce(tx_time - lag(tx_time) OVER w > INTERVAL 2 DAY, true) AS begins
  FROM transactions WHERE tx_time IS NOT NULL
  WINDOW w AS (PARTITION BY student, problem, step ORDER BY tx_time)
),
dealt AS (
  SELECT *, sum(CASE WHEN begins THEN 1 ELSE 0 END) OVER (
    PARTITION BY student, problem, step ORDER BY tx_time) AS visit
  FROM paused
),
visits AS (
  SELECT student, problem, step, visit, min(tx_time) AS step_start,
         min(tx_time) FILTER (WHERE outcome IN ('correct', 'incorrect', 'hint')) AS first_tx,
         min(tx_time) FILTER (WHERE outcome = 'correct') AS correct_tx,
         max(tx_time) AS step_end, sum(tx_dur) AS dur,
         CAST(CASE arg_min(outcome, (tx_time, tx_id))
                   FILTER (WHERE outcome IN ('correct', 'incorrect', 'hint'))
              WHEN 'correct' THEN 1 WHEN 'incorrect' THEN 0 WHEN 'hint' THEN 0 END AS INTEGER)
           AS cfa,
         CAST(count(*) FILTER (WHERE outcome = 'incorrect') AS BIGINT) AS incorrects,
         CAST(count(*) FILTER (WHERE outcome = 'hint') AS BIGINT) AS hints,
         CAST(count(*) FILTER (WHERE outcome = 'correct') AS BIGINT) AS corrects
  FROM dealt GROUP BY student, problem, step, visit
)"""))
def closed_steps_stream(spark, sf_dir):
    """Events read as a stream; a student's visit to a step is closed after two
    days without a transaction (one day allowed for late ones), leaves the state
    and is numbered among the student's visits to the problem.  Visits that the
    events do not close yet stay in the state."""
    out = run_closed_steps(spark, sf_dir)
    return ts_text(rounded(out, ["dur", "correct_dur", "error_dur"]), ROLLUP_TIMES)
