"""Shared pieces of the registered queries (Spark side and SQL side)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions import skills
from ...sources.fixtures import step_log

# Digits kept for doubles whose last bits depend on summation order.
DIGITS = 9


def rounded(df: DataFrame, cols: Iterable[str], digits: int = DIGITS) -> DataFrame:
    cols = set(cols)
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


# Timestamps leave the registered queries as text with six fractional digits,
# the same on both sides of the check, whatever unit a client converts
# datetimes to.
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def ts_text(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    cols = set(cols)
    return df.select(*[F.date_format(F.col(c), TS_TEXT).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def ts_sql(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S.%f') AS {col}"


def key_rows(spark: SparkSession, sf_dir: str, *, with_view: bool = False,
             with_row: bool = False) -> DataFrame:
    """Step rows with the derived unit and section keys."""
    sl = step_log(spark, sf_dir, with_view=with_view, with_row=with_row)
    return sl.withColumns({"unit": skills.unit_of("hierarchy"),
                           "section": skills.section_of("hierarchy")})


def train_of(df: DataFrame) -> DataFrame:
    return df.where(F.col("split") == "train")


def test_of(df: DataFrame) -> DataFrame:
    return df.where(F.col("split") == "test")


# ---- SQL side -----------------------------------------------------------

UNIT_SQL = "split_part(hierarchy, ',', 1)"
SECTION_SQL = ("CASE WHEN strpos(hierarchy, ',') > 0 "
               "THEN substr(hierarchy, strpos(hierarchy, ',') + 1) END")
KC_NUM_SQL = "CAST(coalesce(len(string_split(nullif(kc, ''), '~~')), 0) AS BIGINT)"
OPP_LIST_SQL = "list_transform(string_split(nullif(opportunity, ''), '~~'), lambda x: TRY_CAST(x AS BIGINT))"
OPP_MEAN_SQL = f"coalesce(CAST(list_avg({OPP_LIST_SQL}) AS DOUBLE), 0.0)"
OPP_MIN_SQL = f"CAST(coalesce(list_min({OPP_LIST_SQL}), 0) AS BIGINT)"

KEY_ROWS_SQL = f"""
key_rows AS (
  SELECT *, {UNIT_SQL} AS unit, {SECTION_SQL} AS section FROM step_log
)"""


def r(expr: str, digits: int = DIGITS) -> str:
    return f"round({expr}, {digits})"
