"""Sources and sinks: TSV round trip, feature store, column conforming."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import skills
from ...session import scratch_path
from ...sources import store, tsv
from ...sources.fixtures import step_log
from ..oracle import with_steps
from ..registry import register
from .common import KEY_ROWS_SQL, SECTION_SQL, UNIT_SQL, key_rows, rounded, test_of, ts_sql, ts_text
from ..features import FEATURES, feature_table
from .features import RATE_FEATURES, _feature_select, features_df, features_sql

STEP_FILE_COLS = [c for c in tsv.FILE_ORDER if c != "row"]


_TIMES = ["step_start", "first_tx", "correct_tx", "step_end"]


@register("tsv_roundtrip", with_steps(
    "SELECT split, " + ", ".join(ts_sql(c) if c in _TIMES else c for c in STEP_FILE_COLS)
    + " FROM step_log"))
def tsv_roundtrip(spark, sf_dir):
    """Step rows written as a tab-separated file with the file column names,
    read back through the null-spelling normalisation and typed casts."""
    sl = step_log(spark, sf_dir, with_view=True).select("split", *STEP_FILE_COLS)
    path = scratch_path(spark, "steps-tsv")
    tsv.write_steps(sl, path)
    return ts_text(tsv.read_steps(spark, path), _TIMES)


@register("feature_store", features_sql(_feature_select()))
def feature_store(spark, sf_dir):
    """Feature table saved as parquet partitioned by split, then reloaded."""
    path = scratch_path(spark, "features")
    store.save_features(rounded(features_df(spark, sf_dir, with_row=False), RATE_FEATURES), path)
    return store.load_features(spark, path).select("split", *FEATURES)


_TEST_FILE_COLS = ("split", "student", "hierarchy", "problem", "problem_view", "step", "cfa",
                   "kc", "opportunity")
SQL_TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
             "double": "DOUBLE", "int": "INTEGER"}


def _conform_col(c: str) -> str:
    if c == "unit":
        return f"{UNIT_SQL} AS unit"
    if c == "section":
        return f"{SECTION_SQL} AS section"
    t = SQL_TYPES[tsv.TYPES[c]]
    return f"CAST({c if c in _TEST_FILE_COLS else 'NULL'} AS {t}) AS {c}"


_conform_cols = [_conform_col(c) for c in tsv.SPLIT_ORDER]


@register("conform_schema", with_steps("SELECT " + ", ".join(_conform_cols) + " FROM test"))
def conform_schema(spark, sf_dir):
    """Test rows as a test file holds them, conformed to the 21-column layout
    of the notebook: absent columns come back as typed nulls, extras dropped."""
    test = test_of(key_rows(spark, sf_dir, with_view=True))
    test_file = test.select(*_TEST_FILE_COLS, "unit", "section")
    return tsv.conform(test_file, tsv.SPLIT_ORDER)


# The columns the PySpark path drops before export (Hints twice).
DROPPED = ("row", "hierarchy", "step_start", "first_tx", "correct_tx", "step_end", "dur",
           "correct_dur", "error_dur", "incorrects", "hints", "corrects", "hints",
           "opportunity", "kc")


@register("drop_columns", with_steps(f"""
SELECT split, student, problem, step, cfa, {UNIT_SQL} AS unit, {SECTION_SQL} AS section
FROM step_log"""))
def drop_columns(spark, sf_dir):
    """The step rows after the export drop list (repeats are harmless)."""
    rows = key_rows(spark, sf_dir)
    return rows.drop(*DROPPED).drop("truth")


# The second KC model of the query: the unit as the only KC of a step, its
# opportunity the first number of the default model's.
_RULES = """
rules AS (SELECT * REPLACE (split_part(hierarchy, ',', 1) AS kc,
                            split_part(opportunity, '~~', 1) AS opportunity) FROM step_log)"""


def _rules_sql() -> str:
    sql = features_sql(_feature_select())
    # the key rows read the second model's columns instead
    return sql.replace(KEY_ROWS_SQL.strip(), f"{_RULES.strip()},\n" + KEY_ROWS_SQL.strip().replace(
        "FROM step_log", "FROM rules"), 1)


@register("feature_table_kc_model", _rules_sql())
def feature_table_kc_model(spark, sf_dir):
    """The feature table for a second KC model that comes with the step files as
    the columns KC(Rules) and Opportunity(Rules)."""
    steps = step_log(spark, sf_dir, with_view=True).select("split", *STEP_FILE_COLS).withColumns({
        "kc_rules": skills.unit_of("hierarchy"),
        "opportunity_rules": F.substring_index("opportunity", "~~", 1)})
    path = scratch_path(spark, "steps-two-models")
    tsv.write_steps(steps, path, compression="gzip")
    read = tsv.read_steps(spark, path)
    ft = feature_table(read, id_cols=("split",), kc_model=tsv.kc_models(read)[1])
    return rounded(ft, RATE_FEATURES)


# Faults planted in the lines of the test rows, by row number (period, then the
# remainder of each fault).
FAULT_EVERY = 97
FAULTS = (tsv.FEW, tsv.MANY, tsv.OPEN_QUOTE, tsv.HEADER_AGAIN)
N_FIELDS = len(tsv.FILE_ORDER)


@register("tsv_quarantine", with_steps(f"""
SELECT row, student, NULL AS reason, CAST(NULL AS INTEGER) AS n_fields FROM test
WHERE row % {FAULT_EVERY} > 2
UNION ALL
SELECT row, NULL, CASE row % {FAULT_EVERY} WHEN 0 THEN '{tsv.FEW}' WHEN 1 THEN '{tsv.MANY}'
                                           ELSE '{tsv.OPEN_QUOTE}' END,
       CAST(CASE row % {FAULT_EVERY} WHEN 0 THEN {N_FIELDS} - 1 WHEN 1 THEN {N_FIELDS} + 1
                                     ELSE {N_FIELDS} END AS INTEGER)
FROM test WHERE row % {FAULT_EVERY} <= 2
UNION ALL
SELECT NULL, NULL, '{tsv.HEADER_AGAIN}', {N_FIELDS} FROM test WHERE row % {FAULT_EVERY} = 3"""))
def tsv_quarantine(spark, sf_dir):
    """The test rows as a file with broken lines: the rows of the good lines, and
    the row number (where there is one), reason and field count of the others."""
    rows = test_of(step_log(spark, sf_dir, with_row=True)).select(*tsv.FILE_ORDER)
    header, lines = tsv.to_lines(rows)
    fault, line = F.col("order") % FAULT_EVERY, F.col("value")
    hurt = (F.when(fault == 0, F.regexp_replace(line, "\t[^\t]*$", ""))
            .when(fault == 1, F.concat(line, F.lit("\tmore")))
            .when(fault == 2, F.regexp_replace(line, "^([^\t]*)\t", "$1\t\"")).otherwise(line))
    both = F.when(fault == 3, F.array(hurt, F.lit(header))).otherwise(F.array(hurt))
    path = scratch_path(spark, "broken-tsv")
    tsv.write_lines(header, lines.select("order", F.explode(both).alias("value")), path)
    good, broken = tsv.read_checked(spark, path)
    first = F.regexp_extract("value", "^([0-9]*)\t", 1)
    return good.select("row", "student", F.lit(None).cast("string").alias("reason"),
                       F.lit(None).cast("int").alias("n_fields")).unionByName(
        broken.select(first.try_cast("bigint").alias("row"),
                      F.lit(None).cast("string").alias("student"), "reason", "n_fields"))
