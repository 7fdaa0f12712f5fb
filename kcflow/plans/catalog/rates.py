"""Rates, counts and the per-row scalar features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import skills
from ...operators.rates import add_rate, correct_counts, stacked_counts
from ...operators.sequence import materialize
from ...session import scratch_path
from ...sources import rate_store
from ...sources.fixtures import step_log
from ..oracle import with_steps
from ..registry import register
from .common import KC_NUM_SQL, KEY_ROWS_SQL, OPP_MEAN_SQL, OPP_MIN_SQL, key_rows, r, rounded, \
    test_of, train_of

RATE_KEYS = {"student": "personal_cfar", "problem": "problem_cfar", "step": "step_cfar",
             "kc": "kc_cfar", "unit": "unit_cfar", "section": "section_cfar"}


def _rate_sql(key: str, name: str) -> str:
    return with_steps(f"""
SELECT t.{key}, {r(f"coalesce(g.{name}, (SELECT avg({name}) FROM g))")} AS {name}
FROM key_rows t LEFT JOIN g ON t.{key} = g.{key}
WHERE t.split = 'test'
""", KEY_ROWS_SQL, f"""
g AS (SELECT {key}, count(*) FILTER (WHERE cfa = 1) / count(*) AS {name}
      FROM key_rows WHERE split = 'train' AND {key} IS NOT NULL GROUP BY {key})""")


def _make_rate_query(key: str, name: str):
    def q(spark, sf_dir):
        rows = key_rows(spark, sf_dir)
        out = add_rate(train_of(rows), test_of(rows), key, name).select(key, name)
        return rounded(out, [name])
    q.__name__ = f"rate_{key}"
    return q


for _k, _n in RATE_KEYS.items():
    register(f"rate_{_k}", _rate_sql(_k, _n))(_make_rate_query(_k, _n))


@register("student_correct_count", with_steps("""
SELECT student, CAST(count(*) FILTER (WHERE cfa = 1) AS BIGINT) AS n_correct
FROM train GROUP BY student"""))
def student_correct_count(spark, sf_dir):
    """Count form of the personal feature (correct rows per student)."""
    train = train_of(step_log(spark, sf_dir, with_view=False))
    return correct_counts(train, "student").select("student", "n_correct")


@register("steps_per_key", with_steps("""
SELECT kc, CAST(count(*) AS BIGINT) AS n FROM train GROUP BY kc"""))
def steps_per_key(spark, sf_dir):
    """Rows per KC string in training; null is its own group."""
    train = train_of(step_log(spark, sf_dir, with_view=False))
    return train.groupBy("kc").agg(F.count(F.lit(1)).alias("n"))


@register("correct_steps", with_steps("""
SELECT student, problem, step, correct_dur FROM train WHERE cfa = 1"""))
def correct_steps(spark, sf_dir):
    train = train_of(step_log(spark, sf_dir, with_view=False))
    return train.where(F.col("cfa") == 1).select("student", "problem", "step", "correct_dur")


def _mean_group_sql() -> str:
    parts = []
    for k in RATE_KEYS:
        parts.append(f"""
SELECT '{k}' AS key, CAST(count(*) AS BIGINT) AS n_groups,
       {r("avg(n_correct / n)")} AS mean_rate,
       {r("avg(n_correct / n) FILTER (WHERE n_correct > 0)")} AS mean_rate_strict,
       {r("avg(n_correct)")} AS mean_correct_count
FROM (SELECT {k}, count(*) FILTER (WHERE cfa = 1) AS n_correct, count(*) AS n
      FROM key_rows WHERE split = 'train' AND {k} IS NOT NULL GROUP BY {k})""")
    return with_steps("\nUNION ALL\n".join(parts), KEY_ROWS_SQL)


@register("mean_group_rate", _mean_group_sql())
def mean_group_rate(spark, sf_dir):
    """Unweighted mean of group rates per key (the fallback values)."""
    counts = stacked_counts(train_of(key_rows(spark, sf_dir)), list(RATE_KEYS))
    rate = F.col("n_correct") / F.col("n")
    out = counts.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.avg(rate).alias("mean_rate"),
        F.avg(F.when(F.col("n_correct") > 0, rate)).alias("mean_rate_strict"),
        F.avg("n_correct").alias("mean_correct_count"))
    return rounded(out, ["mean_rate", "mean_rate_strict", "mean_correct_count"])


STRICT_KEYS = {"student": "personal_cfar", "problem": "problem_cfar", "step": "step_cfar",
               "kc": "kc_cfar"}


def _strict_table_sql() -> str:
    parts = [f"""
SELECT '{k}' AS key, {k} AS value, count(*) FILTER (WHERE cfa = 1) / count(*) AS rate
FROM train WHERE {k} IS NOT NULL GROUP BY {k} HAVING count(*) FILTER (WHERE cfa = 1) > 0"""
             for k in STRICT_KEYS]
    return with_steps("\nUNION ALL\n".join(parts))


@register("rate_strict_table", _strict_table_sql())
def rate_strict_table(spark, sf_dir):
    """Rate tables keeping only keys with a correct row (long form, four keys)."""
    return _strict_rates(train_of(step_log(spark, sf_dir, with_view=False)))


def _strict_rates(train):
    """(key, value, rate) of all four keys in one pass."""
    counts = stacked_counts(train, list(STRICT_KEYS)).where(F.col("n_correct") > 0)
    return counts.select("key", "value", (F.col("n_correct") / F.col("n")).alias("rate"))


def _strict_sql() -> str:
    ctes = [f"""
s_{k} AS (SELECT {k}, count(*) FILTER (WHERE cfa = 1) / count(*) AS {n}
          FROM train WHERE {k} IS NOT NULL GROUP BY {k}
          HAVING count(*) FILTER (WHERE cfa = 1) > 0)""" for k, n in STRICT_KEYS.items()]
    joins = " ".join(f"JOIN s_{k} USING ({k})" for k in STRICT_KEYS)
    cols = ", ".join(STRICT_KEYS) + ", " + ", ".join(STRICT_KEYS.values())
    return with_steps(f"SELECT {cols} FROM train {joins}", *ctes)


@register("rate_strict", _strict_sql())
def rate_strict(spark, sf_dir):
    """Training rows kept by inner joins with the four strict rate tables."""
    train = train_of(step_log(spark, sf_dir, with_view=False))
    # one row per key value, read once per key below
    rates = materialize(_strict_rates(train), "strict-rates", ["key"])
    rows = train
    for k, n in STRICT_KEYS.items():
        table = rates.where(F.col("key") == k).select(F.col("value").alias(k), F.col("rate").alias(n))
        rows = rows.join(table, k)
    return rows.select(*STRICT_KEYS, *STRICT_KEYS.values())


@register("split_hierarchy", with_steps("""
SELECT DISTINCT hierarchy, unit, section FROM key_rows""", KEY_ROWS_SQL))
def split_hierarchy(spark, sf_dir):
    return key_rows(spark, sf_dir).select("hierarchy", "unit", "section").distinct()


@register("kc_count", with_steps(f"SELECT kc, {KC_NUM_SQL} AS kc_num FROM step_log"))
def kc_count(spark, sf_dir):
    sl = step_log(spark, sf_dir, with_view=False)
    return sl.select("kc", skills.kc_count("kc").alias("kc_num"))


@register("opportunity_stats", with_steps(f"""
SELECT opportunity, {OPP_MEAN_SQL} AS opportunity_mean, {OPP_MIN_SQL} AS opportunity_min
FROM step_log"""))
def opportunity_stats(spark, sf_dir):
    sl = step_log(spark, sf_dir, with_view=False)
    return sl.select("opportunity",
                     skills.opportunity_mean("opportunity").alias("opportunity_mean"),
                     skills.opportunity_min("opportunity").alias("opportunity_min"))


@register("kc_length", with_steps(
    "SELECT kc, CAST(coalesce(length(kc), 0) AS BIGINT) AS kc_length FROM step_log"))
def kc_length(spark, sf_dir):
    sl = step_log(spark, sf_dir, with_view=False)
    return sl.select("kc", skills.kc_length("kc").alias("kc_length"))


# The query's training files: the rows by row number, in batches.
BATCHES = 3
_stacked_sql = " UNION ALL ".join(
    f"SELECT '{k}' AS feature, {k} AS value, row % {BATCHES} AS batch, cfa FROM key_rows "
    "WHERE split = 'train'" for k in RATE_KEYS)


@register("rates_merged", with_steps("""
SELECT feature, value, n, n_correct, round(n_correct / n, 9) AS rate,
       row_number() OVER (PARTITION BY feature ORDER BY first_batch, value NULLS FIRST) - 1 AS code
FROM (SELECT feature, value, count(*) AS n, count(*) FILTER (WHERE cfa = 1) AS n_correct,
             min(batch) AS first_batch FROM stacked GROUP BY feature, value)""",
                                     KEY_ROWS_SQL, f"\nstacked AS ({_stacked_sql})"))
def rates_merged(spark, sf_dir):
    """Counts, rates and codes of all keys after three batches of training files were
    merged into the store one after the other."""
    files, path = scratch_path(spark, "training-files"), scratch_path(spark, "rate-store")
    train_of(key_rows(spark, sf_dir, with_row=True)).select(
        "cfa", *RATE_KEYS, (F.col("row") % BATCHES).alias("batch")).write.partitionBy(
            "batch").parquet(files)
    for b in range(BATCHES):
        rate_store.update(path, spark.read.parquet(f"{files}/batch={b}"), f"batch={b}",
                          list(RATE_KEYS))
    table = rate_store.load(spark, path).withColumn("rate", F.col("n_correct") / F.col("n"))
    return rounded(table, ["rate"])
