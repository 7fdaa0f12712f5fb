"""Codes, dictionaries and the flagship feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators.encoding import code_dictionaries, code_dictionary, encode_all, \
    key_dictionary, one_hot_long, one_hot_vectors, vector_indices
from ...operators.sequence import materialize
from ...session import scratch_path
from ...sources import tsv
from ..features import FEATURES, feature_table, read_features, write_features
from ..oracle import with_steps
from ..registry import register
from .common import KC_NUM_SQL, KEY_ROWS_SQL, OPP_MEAN_SQL, OPP_MIN_SQL, key_rows, r, rounded, \
    ts_sql, ts_text

CODED = ("student", "problem", "unit", "section", "step", "hierarchy")
RATED = {"student": "personal_cfar", "problem": "problem_cfar", "step": "step_cfar",
         "kc": "kc_cfar"}
RATE_FEATURES = tuple(RATED.values())
INPUT_FEATURES = tuple(c for c in FEATURES if c != "cfa")


def _code_cte(k: str) -> str:
    return f"""
c_{k} AS (SELECT {k}, CAST(row_number() OVER (ORDER BY {k} ASC NULLS FIRST) - 1 AS BIGINT) AS code
          FROM (SELECT DISTINCT {k} FROM feat_rows))"""


def _make_encode(k: str):
    def q(spark, sf_dir):
        rows = key_rows(spark, sf_dir)
        return code_dictionary([rows.where(F.col("split") == "train"),
                                rows.where(F.col("split") == "test")], k)
    q.__name__ = f"encode_{k}"
    return q


for _k in CODED:
    register(f"encode_{_k}", with_steps(f"SELECT {_k}, code FROM c_{_k}", KEY_ROWS_SQL,
                                        "feat_rows AS (SELECT * FROM key_rows)",
                                        _code_cte(_k)))(_make_encode(_k))


@register("key_dictionary", with_steps("""
SELECT DISTINCT kc FROM (SELECT kc FROM train UNION ALL SELECT kc FROM test)"""))
def key_dictionary_q(spark, sf_dir):
    """Distinct KC strings of train and test (null kept)."""
    rows = key_rows(spark, sf_dir)
    return key_dictionary([rows.where(F.col("split") == "train"),
                           rows.where(F.col("split") == "test")], "kc")


FEATURE_CTES = (KEY_ROWS_SQL, f"""
feat_rows AS (
  SELECT split, row, student, problem, step, problem_view, cfa, kc, unit, section,
         {KC_NUM_SQL} AS kc_num, {OPP_MEAN_SQL} AS opportunity_mean,
         {OPP_MIN_SQL} AS opportunity_min
  FROM key_rows)""", *[f"""
g_{k} AS (SELECT {k}, count(*) FILTER (WHERE cfa = 1) / count(*) AS v
          FROM feat_rows WHERE split = 'train' AND {k} IS NOT NULL GROUP BY {k})"""
                       for k in RATED], *[_code_cte(k) for k in ("student", "problem", "unit",
                                                                "section", "step")], f"""
features AS (
  SELECT f.split, f.row,
    coalesce(g_student.v, (SELECT avg(v) FROM g_student)) AS personal_cfar,
    coalesce(g_problem.v, (SELECT avg(v) FROM g_problem)) AS problem_cfar,
    c_student.code AS student, c_unit.code AS unit, c_section.code AS section,
    c_step.code AS step, c_problem.code AS problem,
    f.problem_view, f.cfa, f.kc_num,
    coalesce(g_step.v, (SELECT avg(v) FROM g_step)) AS step_cfar,
    coalesce(g_kc.v, (SELECT avg(v) FROM g_kc)) AS kc_cfar,
    f.opportunity_mean, f.opportunity_min
  FROM feat_rows f
  LEFT JOIN g_student ON f.student = g_student.student
  LEFT JOIN g_problem ON f.problem = g_problem.problem
  LEFT JOIN g_step ON f.step = g_step.step
  LEFT JOIN g_kc ON f.kc = g_kc.kc
  LEFT JOIN c_student ON f.student IS NOT DISTINCT FROM c_student.student
  LEFT JOIN c_problem ON f.problem IS NOT DISTINCT FROM c_problem.problem
  LEFT JOIN c_unit ON f.unit IS NOT DISTINCT FROM c_unit.unit
  LEFT JOIN c_section ON f.section IS NOT DISTINCT FROM c_section.section
  LEFT JOIN c_step ON f.step IS NOT DISTINCT FROM c_step.step
)""")


def features_sql(body: str, *extra: str) -> str:
    return with_steps(body, *FEATURE_CTES, *extra)


def _feature_select() -> str:
    cols = ", ".join(r(c) + f" AS {c}" if c in RATE_FEATURES else c for c in FEATURES)
    return f"SELECT split, {cols} FROM features"


def features_df(spark, sf_dir, with_row: bool = True, **kw):
    ids = ("split", "row") if with_row else ("split",)
    return feature_table(key_rows(spark, sf_dir, with_view=True, with_row=True),
                         id_cols=ids, **kw)


@register("feature_table", features_sql(_feature_select()))
def feature_table_q(spark, sf_dir):
    """Flagship: the 14 features for every train and test row (no row id,
    like the reference's feature files)."""
    return rounded(features_df(spark, sf_dir, with_row=False), RATE_FEATURES)


def _variant_sql(count_students: bool = False, strict: bool = False) -> str:
    """The feature table again, with another student statistic or inner joins."""
    sql = features_sql(_feature_select())
    if count_students:
        head, tail = sql.split("g_student AS (", 1)
        tail = tail.replace("count(*) FILTER (WHERE cfa = 1) / count(*) AS v",
                            "CAST(count(*) FILTER (WHERE cfa = 1) AS DOUBLE) AS v", 1)
        sql = head + "g_student AS (" + tail
    if strict:
        for k in RATED:
            sql = sql.replace(f"AND {k} IS NOT NULL GROUP BY {k})",
                              f"AND {k} IS NOT NULL GROUP BY {k}\n"
                              "          HAVING count(*) FILTER (WHERE cfa = 1) > 0)")
            sql = sql.replace(f"LEFT JOIN g_{k} ON", f"JOIN g_{k} ON")
    return sql


@register("feature_table_count", _variant_sql(count_students=True))
def feature_table_count(spark, sf_dir):
    """The feature table with the number of correct steps as the student's value."""
    ft = features_df(spark, sf_dir, with_row=False, stat={"student": "count"})
    return rounded(ft, RATE_FEATURES)


@register("feature_table_strict", _variant_sql(strict=True))
def feature_table_strict(spark, sf_dir):
    """The feature table without rows (train or test) that have a key of no rate."""
    ft = features_df(spark, sf_dir, with_row=False, fallback="drop")
    return rounded(ft, RATE_FEATURES)


@register("feature_tsv", features_sql(_feature_select()))
def feature_tsv(spark, sf_dir):
    """The feature table written as tab-separated files with the original column
    names, read back with its types."""
    ft = rounded(features_df(spark, sf_dir, with_row=False), RATE_FEATURES)
    path = scratch_path(spark, "features-tsv")
    write_features(ft, path)
    return read_features(spark, path, ft.schema)


SPLIT_CODED = ("student", "hierarchy", "unit", "section", "problem", "step")


def _encoded_sql() -> str:
    cols = []
    for c in tsv.SPLIT_ORDER:
        if c in SPLIT_CODED:
            cols.append(f"c_{c}.code AS {c}")
        else:
            cols.append(ts_sql(c) if tsv.TYPES[c] == "timestamp_ntz" else f"f.{c}")
    joins = " ".join(f"JOIN c_{c} ON f.{c} IS NOT DISTINCT FROM c_{c}.{c}" for c in SPLIT_CODED)
    return with_steps(f"SELECT f.split, {', '.join(cols)} FROM key_rows f {joins}", KEY_ROWS_SQL,
                      "feat_rows AS (SELECT * FROM key_rows)", *[_code_cte(c) for c in SPLIT_CODED])


@register("encoded_steps", _encoded_sql())
def encoded_steps(spark, sf_dir):
    """The 21-column step table with six columns replaced by codes that training
    and test rows share."""
    rows = key_rows(spark, sf_dir, with_view=True, with_row=True)
    out = encode_all(rows, code_dictionaries(rows, SPLIT_CODED), SPLIT_CODED, ("split", "row"))
    times = [c for c in tsv.SPLIT_ORDER if tsv.TYPES[c] == "timestamp_ntz"]
    return ts_text(out.select("split", *tsv.SPLIT_ORDER), times)


@register("one_hot_sparse", features_sql("""
SELECT split, row, [student, sizes.n1 + unit, sizes.n1 + sizes.n2 + section,
       sizes.n1 + sizes.n2 + sizes.n3 + step,
       sizes.n1 + sizes.n2 + sizes.n3 + sizes.n4 + problem]::VARCHAR AS indices
FROM features, (SELECT max(student) + 1 AS n1, max(unit) + 1 AS n2, max(section) + 1 AS n3,
                       max(step) + 1 AS n4 FROM features) sizes"""))
def one_hot_sparse(spark, sf_dir):
    """The one-hot matrix as one sparse vector per row: positions of its ones."""
    coded = ["student", "unit", "section", "step", "problem"]
    # read twice: for the number of slots and for the vectors
    ft = materialize(features_df(spark, sf_dir).select("split", "row", *coded), "one-hot-input")
    vectors = one_hot_vectors(ft, coded)
    return vectors.select("split", "row", F.concat(
        F.lit("["), F.array_join(vector_indices("one_hot"), ", "), F.lit("]")).alias("indices"))


@register("one_hot_long", features_sql("""
SELECT split, row, feature, code FROM (
  SELECT split, row, unnest([
    {'feature': 'student', 'code': student}, {'feature': 'unit', 'code': unit},
    {'feature': 'section', 'code': section}, {'feature': 'step', 'code': step},
    {'feature': 'problem', 'code': problem}], recursive := true)
  FROM features)"""))
def one_hot_long_q(spark, sf_dir):
    """Set bits of the one-hot matrix of the five coded columns."""
    ft = features_df(spark, sf_dir)
    return one_hot_long(ft, ["split", "row"], ["student", "unit", "section", "step", "problem"])
