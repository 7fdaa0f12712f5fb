"""Building step records from transaction logs (the data-set construction).

All per-key work is aggregation (partial, map-side combined) or the
skew-safe ``running_index``; per-row list handling uses array functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import skills
from .sequence import running_index

# Outcomes of a transaction that count as an attempt.
CORRECT, INCORRECT, HINT = "correct", "incorrect", "hint"
ATTEMPTS = (CORRECT, INCORRECT, HINT)

# Columns the test file does not carry (CFA itself is withheld only in part).
WITHHELD = ("step_start", "first_tx", "correct_tx", "step_end", "dur", "correct_dur",
            "error_dur", "incorrects", "hints", "corrects")


# The challenge form withholds the label too: all 11 columns.
CHALLENGE_WITHHELD = (*WITHHELD, "cfa")


def step_rollup(tx: DataFrame, keys: Sequence[str] = ("student", "problem", "step"),
                time_col: str = "tx_time", id_col: str = "tx_id",
                outcome_col: str = "outcome", dur_col: str = "tx_dur") -> DataFrame:
    """One step record per (student, problem, step) from its transactions.

    The first attempt is the attempt with the smallest (time, id); the step is
    correct at the first attempt when that attempt is correct.  Durations sum
    over all transactions of the step.
    """
    rolled = tx.groupBy(*keys).agg(*rollup_aggregates(time_col, id_col, outcome_col, dur_col))
    return finish_rollup(rolled, keys)


def rollup_aggregates(time_col: str = "tx_time", id_col: str = "tx_id",
                      outcome_col: str = "outcome", dur_col: str = "tx_dur") -> list[Column]:
    """The per-step aggregates of the roll-up (shared by batch and stream)."""
    t, o = F.col(time_col), F.col(outcome_col)
    attempt = o.isin(*ATTEMPTS)
    first = F.min(F.when(attempt, F.struct(t.alias("t"), F.col(id_col).alias("i"),
                                           o.alias("o"))))
    return [F.min(t).alias("step_start"),
            F.min(F.when(attempt, t)).alias("first_tx"),
            F.min(F.when(o == CORRECT, t)).alias("correct_tx"),
            F.max(t).alias("step_end"),
            F.sum(dur_col).alias("dur"),
            first["o"].alias("_first"),
            F.count_if(o == INCORRECT).cast("bigint").alias("incorrects"),
            F.count_if(o == HINT).cast("bigint").alias("hints"),
            F.count_if(o == CORRECT).cast("bigint").alias("corrects")]


def finish_rollup(rolled: DataFrame, keys: Sequence[str] = ("student", "problem", "step")
                  ) -> DataFrame:
    """CFA and the split of the duration, from the aggregated columns."""
    cfa = F.when(F.col("_first") == CORRECT, 1).when(F.col("_first").isNotNull(), 0).cast("int")
    return rolled.select(
        *keys, "step_start", "first_tx", "correct_tx", "step_end", "dur",
        F.when(cfa == 1, F.col("dur")).alias("correct_dur"),
        F.when(cfa == 0, F.col("dur")).alias("error_dur"),
        cfa.alias("cfa"), "incorrects", "hints", "corrects")


def problem_views(steps: DataFrame, order_cols: Sequence[str | Column],
                  out: str = "problem_view", **kw) -> DataFrame:
    """Running count of a student's encounters with each problem."""
    return running_index(steps, ["student", "problem"], order_cols, out, **kw)


def opportunity_counts(steps: DataFrame, id_cols: Sequence[str],
                       order_cols: Sequence[str | Column], kc_col: str = "kc",
                       out: str = "opportunity_count") -> DataFrame:
    """Opportunity string per step: for each KC, the how-many-th step of the
    student with that KC this is.  Several attempts at a step count once, and so
    does a KC that a step lists more than once: every place of it gets the
    same number.

    Rows without KC are left out.  ``id_cols`` must identify a step row.
    """
    keep = list(dict.fromkeys([*id_cols, "student",
                               *[c for c in order_cols if isinstance(c, str)]]))
    kcs = F.col("_kc_list")
    places = F.sequence(F.lit(0), F.size(kcs) - 1)
    each = F.transform(F.array_distinct(kcs), lambda k: F.struct(
        k.alias("_kc_one"), F.filter(places, lambda i: F.get(kcs, i) == k).alias("_kc_at")))
    once = steps.where(F.size(skills.kc_list(kc_col)) > 0).select(
        *keep, skills.kc_list(kc_col).alias("_kc_list")).select(*keep, F.inline(each))
    numbered = running_index(once, ["student", "_kc_one"], order_cols, "_kc_n")
    per_row = numbered.select(*id_cols, "_kc_n", F.explode("_kc_at").alias("_kc_pos")).groupBy(
        *id_cols).agg(F.array_sort(F.collect_list(F.struct("_kc_pos", "_kc_n"))).alias("_kc_ns"))
    return per_row.select(*id_cols, F.array_join(
        F.transform("_kc_ns", lambda s: s["_kc_n"].cast("string")), "~~").alias(out))


def holdout_split(steps: DataFrame, unit_col: str = "unit", time_col: str = "first_tx",
                  out: str = "part") -> DataFrame:
    """Per (student, unit) one problem, picked by a hash, becomes test; rows of
    the unit strictly before its first step are train, the rest discard."""
    pick = steps.groupBy("student", unit_col).agg(
        F.min_by("problem", F.md5(F.concat_ws("|", "student", "problem"))).alias("_kc_test"))
    starts = steps.groupBy("student", unit_col, "problem").agg(F.min(time_col).alias("_kc_start"))
    chosen = pick.join(starts.withColumnRenamed("problem", "_kc_test"),
                       ["student", unit_col, "_kc_test"])
    tagged = steps.join(chosen, ["student", unit_col], "left")
    part = (F.when(F.col("problem") == F.col("_kc_test"), "test")
            .when(F.col(time_col) < F.col("_kc_start"), "train").otherwise("discard"))
    return tagged.withColumn(out, part).drop("_kc_test", "_kc_start")


def mask_test(steps: DataFrame, cols: Sequence[str] = WITHHELD) -> DataFrame:
    """Blank the columns a test file does not carry on test rows."""
    is_test = F.col("split") == "test"
    return steps.withColumns({c: F.when(~is_test, F.col(c)) for c in cols if c in steps.columns})


def explode_kcs(df: DataFrame, kc_col: str = "kc", out: str = "kc_one") -> DataFrame:
    """One row per distinct KC of a step."""
    return df.withColumn(out, F.explode(F.array_distinct(skills.kc_list(kc_col))))


def explode_opportunities(df: DataFrame, opp_col: str = "opportunity",
                          out: str = "opportunity") -> DataFrame:
    return df.withColumn(out, F.explode(skills.opportunity_list(opp_col)))


def record_checks(steps: DataFrame) -> DataFrame:
    """Rows that break the step-record rules (counts, one row)."""
    cfa = F.col("cfa")
    n_kc = F.coalesce(F.size(skills.kc_list("kc")), F.lit(0))
    n_opp = F.coalesce(F.size(skills.opportunity_list("opportunity")), F.lit(0))
    return steps.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.count_if(F.col("correct_dur").isNotNull() & cfa.isNotNull() & (cfa != 1))
         .cast("bigint").alias("bad_correct_dur"),
        F.count_if(F.col("error_dur").isNotNull() & cfa.isNotNull() & (cfa != 0))
         .cast("bigint").alias("bad_error_dur"),
        F.count_if(n_kc != n_opp).cast("bigint").alias("bad_kc_lists"))
