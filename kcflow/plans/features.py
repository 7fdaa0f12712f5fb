"""The 14-column feature table shared by training and prediction.

One dictionary of all keys carries each key's code and its rate (one row per
distinct key).  The rows meet it by ``operators.lookup``: small keys by
broadcast, all large ones together in one narrow shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import skills
from ..operators.lookup import HOT_SHARE, attach, key_counts
from ..operators.sequence import materialize, running_index

FEATURES = ("personal_cfar", "problem_cfar", "student", "unit", "section", "step", "problem",
            "problem_view", "cfa", "kc_num", "step_cfar", "kc_cfar", "opportunity_mean",
            "opportunity_min")

# key column -> (rate feature or None, coded?)
KEY_FEATURES = (
    ("student", "personal_cfar", True),
    ("problem", "problem_cfar", True),
    ("step", "step_cfar", True),
    ("kc", "kc_cfar", False),
    ("unit", None, True),
    ("section", None, True),
)

# Reference column names of the feature table (for TSV export).
EXPORT_NAMES = {
    "personal_cfar": "Personal CFAR", "problem_cfar": "Problem CFAR",
    "student": "Anon Student Id", "unit": "Problem Unit", "section": "Problem Section",
    "step": "Step Name", "problem": "Problem Name", "problem_view": "Problem View",
    "cfa": "Correct First Attempt", "kc_num": "KC_num", "step_cfar": "Step CFAR",
    "kc_cfar": "KC CFAR", "opportunity_mean": "Opportunity(Mean)",
    "opportunity_min": "Opportunity(Min)",
}


def step_features(steps: DataFrame, id_cols=("split", "row"),
                  kc_model: tuple[str, str] = ("kc", "opportunity")) -> DataFrame:
    """Per-row features that need no other row: hierarchy split, KC counts.

    ``kc_model`` names the KC and opportunity columns to use."""
    steps = steps.withColumns({"kc": F.col(kc_model[0]), "opportunity": F.col(kc_model[1])})
    return steps.select(
        *id_cols, "student", "problem", "step", "problem_view", "cfa", "kc",
        skills.unit_of("hierarchy").alias("unit"),
        skills.section_of("hierarchy").alias("section"),
        skills.kc_count("kc").alias("kc_num"),
        skills.opportunity_mean("opportunity").alias("opportunity_mean"),
        skills.opportunity_min("opportunity").alias("opportunity_min"))


def key_dimensions(rows: DataFrame, is_train, *, stat: str | dict[str, str] = "rate",
                   fallback: str = "mean") -> DataFrame:
    """``(feature, value, n_rows, code, rate)`` for every key column in one pass.

    The key columns are stacked into (feature, value) pairs and aggregated
    once over all rows: the distinct values are the dictionary (codes come
    from all rows, null included), the training counts give the rates.
    The fallback mean per feature is an aggregate of at most one row per
    key column, so it is broadcast with a known bound.  With
    ``fallback='mean'`` every value carries its filled rate; with ``'drop'``
    only values with a correct training row carry one.
    """
    keys = [k for k, _, _ in KEY_FEATURES]
    counts = key_counts(
        rows, keys, F.count_if(F.col("_kc_train")).cast("bigint").alias("n"),
        F.count_if(F.col("_kc_train") & F.col("_kc_ok")).cast("bigint").alias("n_correct"),
        extra=[is_train.alias("_kc_train"), (F.col("cfa") == 1).alias("_kc_ok")])
    has_rate = F.col("value").isNotNull() & (F.col("n") > 0)
    if fallback == "drop":
        has_rate = has_rate & (F.col("n_correct") > 0)
    elif fallback != "mean":
        raise ValueError("fallback must be 'mean' or 'drop'")
    stats = stat if isinstance(stat, dict) else {k: stat for k in keys}
    if not set(stats.values()) <= {"rate", "count"}:
        raise ValueError("stat must be 'rate' or 'count'")
    counted = [k for k, s in stats.items() if s == "count"]
    value = F.when(F.col("feature").isin(*counted), F.col("n_correct").cast("double")) \
        .otherwise(F.try_divide(F.col("n_correct"), F.col("n")))
    coded = running_index(counts, ["feature"], [F.col("value").asc_nulls_first()], "_kc_pos")
    dims = coded.select("feature", "value", "n_rows",
                        (F.col("_kc_pos") - 1).cast("bigint").alias("code"),
                        F.when(has_rate, value).alias("rate"))
    means = dims.groupBy("feature").agg(F.avg("rate").alias("_kc_mean"))
    dims = dims.join(F.broadcast(means), "feature")
    dims = dims.select("feature", "value", "n_rows", "code",
                       (F.col("rate") if fallback == "drop"
                        else F.coalesce("rate", "_kc_mean")).alias("rate"))
    # One row per distinct key: small next to the rows, and read once per lookup
    # below, so it is written, a folder per feature.
    return materialize(dims, "dims", ["feature"])


def feature_table(steps: DataFrame, *, stat: str | dict[str, str] = "rate",
                  fallback: str = "mean",
                  id_cols=("split", "row"), train_filter=None,
                  kc_model: tuple[str, str] = ("kc", "opportunity"),
                  hot_share: int = HOT_SHARE) -> DataFrame:
    """Features for every row of ``steps`` (train and test together).

    Rates are learnt on the training rows (``split = 'train'`` unless
    ``train_filter`` says otherwise); codes come from all rows.  ``stat`` is
    'rate' or 'count' for all keys, or a dict of key column to either
    (keys left out use the rate).  ``kc_model`` picks one of the table's KC
    models (``tsv.kc_models``).  Steps with ``split`` and ``row`` are told apart by
    them; others are numbered when a key is too large to broadcast.
    """
    row_key = [c for c in ("split", "row") if c in steps.columns]
    row_key = row_key if len(row_key) == 2 else []
    rows = step_features(steps, list(dict.fromkeys([*id_cols, *row_key])), kc_model)
    is_train = train_filter if train_filter is not None else F.col("split") == "train"
    dims = key_dimensions(rows, is_train, stat=stat, fallback=fallback)
    keys = [k for k, _, _ in KEY_FEATURES]
    rows = attach(rows, dims, keys, ["code", "rate"], row_key, hot_share)
    for key, rate_name, coded in KEY_FEATURES:
        if rate_name:
            rows = rows.withColumn(rate_name, F.col(f"_kc_{key}_rate"))
            if fallback == "drop":
                rows = rows.where(F.col(rate_name).isNotNull())
        if coded:
            rows = rows.withColumn(key, F.col(f"_kc_{key}_code"))
    return rows.select(*id_cols, *FEATURES)


def write_features(features: DataFrame, path: str) -> None:
    """Feature files: tab-separated, original column names, a header."""
    features.select(*[F.col(c).alias(EXPORT_NAMES.get(c, c)) for c in features.columns]) \
        .write.option("sep", "\t").option("header", True).csv(path)


def read_features(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Feature files in their types, with the library's column names."""
    raw = spark.read.option("sep", "\t").option("header", True).csv(path)
    return raw.select(*[F.col(f"`{EXPORT_NAMES.get(f.name, f.name)}`").cast(f.dataType)
                        .alias(f.name) for f in schema])
