"""Column expressions for the hierarchy, KC and opportunity strings.

All are built-in Spark expressions (no Python UDF), so they stay inside
whole-stage codegen.  Under ANSI mode the casts of empty pieces would
raise, hence ``nullif`` and ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.fixtures import KC_SEP


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unit_of(hierarchy: str | Column) -> Column:
    """Text before the first comma (all of it when there is none)."""
    return F.split(_c(hierarchy), ",", 2).getItem(0)


def section_of(hierarchy: str | Column) -> Column:
    """Text after the first comma, leading space kept; null without a comma."""
    return F.get(F.split(_c(hierarchy), ",", 2), 1)


def kc_list(kc: str | Column) -> Column:
    """The KC string as an array; null or empty gives null."""
    return F.split(F.nullif(_c(kc), F.lit("")), F.lit(KC_SEP))


def opportunity_list(opp: str | Column) -> Column:
    """The opportunity string as an array of longs; null or empty gives null."""
    return F.transform(F.split(F.nullif(_c(opp), F.lit("")), F.lit(KC_SEP)),
                       lambda x: F.try_cast(x, "bigint") if hasattr(F, "try_cast")
                       else x.try_cast("bigint"))


def kc_count(kc: str | Column) -> Column:
    """Number of KCs: separators + 1; 0 for null or empty."""
    return F.coalesce(F.size(kc_list(kc)).cast("bigint"), F.lit(0).cast("bigint"))


def opportunity_mean(opp: str | Column) -> Column:
    """Mean of the readable opportunity numbers (pieces that are no number are
    left out, as in the minimum); 0.0 for null, empty or nothing readable."""
    arr = F.filter(opportunity_list(opp), lambda x: x.isNotNull())
    total = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return F.coalesce(F.when(F.size(arr) > 0, total / F.size(arr)), F.lit(0.0))


def opportunity_min(opp: str | Column) -> Column:
    """Smallest opportunity number; 0 for null or empty."""
    return F.coalesce(F.array_min(opportunity_list(opp)), F.lit(0).cast("bigint"))


def kc_length(kc: str | Column) -> Column:
    """Length of the KC text; 0 for null."""
    return F.coalesce(F.length(_c(kc)).cast("bigint"), F.lit(0).cast("bigint"))
