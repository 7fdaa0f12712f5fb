"""Describing the data: counts, exact quantiles, histograms, CDF, top-k, correlation.

Every statistic is an aggregate with partial (map-side) combining, so a hot
key is pre-aggregated before any shuffle (the correlations' sums are Arrow batches).  Exact quantiles and medians come
from ``exact_quantiles`` (rank-based, no per-group value buffer).  Tables
that are bounded by a parameter (the bins of a histogram, the pairs of a
correlation matrix) are the only ones handled without a partition key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .sequence import exact_quantiles


def distinct_counts(df: DataFrame, cols: Sequence[str], prefix: str = "n_",
                    approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Number of distinct non-null values per column (one row).

    Exact by default; ``approx=True`` uses HyperLogLog++ sketches (relative
    standard deviation ``rsd``), which merge map-side and never shuffle the
    values themselves.
    """
    if approx:
        return df.agg(*[F.approx_count_distinct(c, rsd).cast("bigint").alias(f"{prefix}{c}")
                        for c in cols])
    return df.agg(*[F.count_distinct(c).cast("bigint").alias(f"{prefix}{c}") for c in cols])


def describe(df: DataFrame, col: str, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """count, mean, std (sample), min, quantiles, max of one column; nulls skipped."""
    names = [f"p{int(round(p * 100))}" for p in probs]
    vals = df.where(F.col(col).isNotNull() & ~F.isnan(col)).select(col)
    moments = vals.agg(F.count(col).cast("bigint").alias("count"), F.avg(col).alias("mean"),
                       F.stddev_samp(col).alias("std"), F.min(col).alias("min"),
                       F.max(col).alias("max"))
    quantiles = exact_quantiles(vals, col, probs, names=names)
    return moments.crossJoin(F.broadcast(quantiles)).select(  # one row each
        "count", "mean", "std", "min", *names, "max")


def group_median(df: DataFrame, key: str | Sequence[str], col: str, out: str = "median") -> DataFrame:
    """Exact median of ``col`` per key; keys without a value are left out."""
    keys = [key] if isinstance(key, str) else list(key)
    return exact_quantiles(df, col, [0.5], group_cols=keys, names=[out])


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """First k rows in ``order`` (per-partition top-k, then one merge of k rows each)."""
    return df.orderBy(*order).limit(k)


def histogram(df: DataFrame, col: str, bins: int, lo: float, hi: float) -> DataFrame:
    """Density histogram with equal bins on [lo, hi], last bin closed.

    Values outside the range are left out of counts and denominator.  All
    bins are returned, empty ones with n = 0.
    """
    spark = df.sparkSession
    width = (hi - lo) / bins
    x = F.col(col).cast("double")
    inside = df.where(x.isNotNull() & (x >= lo) & (x <= hi))
    idx = F.least(F.floor((x - F.lit(lo)) * F.lit(float(bins)) / F.lit(hi - lo)),
                  F.lit(bins - 1)).cast("bigint")
    counts = inside.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    # The bin scaffold has ``bins`` rows, a parameter, not a data size.
    scaffold = spark.range(bins).withColumnRenamed("id", "bin")
    out = scaffold.join(counts, "bin", "left").fillna(0, ["n"])
    return out.select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
        "n",
        (F.col("n") / (total * F.lit(width))).alias("density"))


def cumulative(hist: DataFrame, value: str = "density", out: str = "cdf",
               width: float = 1.0) -> DataFrame:
    """Running sum over the bins of a histogram (bounded by the bin count)."""
    w = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hist.select("bin", "hi", (F.sum(value).over(w) * F.lit(width)).alias(out))


def correlation_long(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of every pair of columns, long form (by..., a, b, corr).

    Each pair uses the rows where both values are present: covariance and
    both variances are taken over the same rows.  A pair without variance (or
    without rows) gives null.

    Every task sums its rows batch by batch (``_moments``) and hands on one row
    per pair, group and set of columns that are missing together; what is shuffled
    follows the tasks, not the rows.
    """
    cols, by = list(cols), list(by)
    kinds = [df.schema[c] for c in by]
    values = df.select(*by, *[F.col(c).cast("double").alias(f"_kc_x{i}")
                              for i, c in enumerate(cols)])
    parts = values.mapInArrow(_moments(by, len(cols)), StructType(
        [*kinds, *[StructField(f"_kc_{c}", LongType()) for c in ("a", "b", "n")],
         *[StructField(f"_kc_{c}", DoubleType()) for c in ("ma", "mb", "va", "vb", "c")]]))
    # means are compared with the least of them: equal ones, those of a constant, differ by 0
    pair = Window.partitionBy(*by, "_kc_a", "_kc_b")
    n = F.col("_kc_n")
    da, db = (F.col(m) - F.min(m).over(pair) for m in ("_kc_ma", "_kc_mb"))
    near = parts.withColumns({"_kc_da": da, "_kc_db": db})
    da, db = F.col("_kc_da"), F.col("_kc_db")
    sums = near.groupBy(*by, "_kc_a", "_kc_b").agg(
        F.sum(n).alias("_kc_n"), F.sum(n * da).alias("sa"), F.sum(n * db).alias("sb"),
        F.sum(F.col("_kc_va") + n * da * da).alias("va"),
        F.sum(F.col("_kc_vb") + n * db * db).alias("vb"),
        F.sum(F.col("_kc_c") + n * da * db).alias("c"))
    va, vb = (F.greatest(F.col(v) - F.try_divide(F.col(s) * F.col(s), n), F.lit(0.0))
              for v, s in (("va", "sa"), ("vb", "sb")))
    c = F.col("c") - F.try_divide(F.col("sa") * F.col("sb"), n)
    found = sums.select(*by, "_kc_a", "_kc_b",
                        F.try_divide(c, F.sqrt(va) * F.sqrt(vb)).alias("corr"))
    row = found.groupBy(*by).agg(*[
        F.max(F.when((F.col("_kc_a") == i) & (F.col("_kc_b") == j), F.col("corr")))
        .alias(f"_c{i}_{j}") for i in range(len(cols)) for j in range(i, len(cols))])
    pairs = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                      F.col(f"_c{min(i, j)}_{max(i, j)}").alias("corr"))
             for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return row.select(*by, F.inline(F.array(*pairs)))


#: Bits of the present columns that make one number.
_MASK_BITS = 31


def _moments(by: Sequence[str], n_cols: int
             ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of the group columns ``by`` and ``n_cols`` doubles to one row per group, set
    of present columns and pair of columns: the pair's places, the rows, both
    means, the sums of squared deviations and of their products.

    Inside such a set every pair has the same rows.  Deviations are taken from its
    first row and then from the mean, so that those of a constant are 0 to the last bit.
    """
    by, n_by = list(by), len(by)
    a, b = np.triu_indices(n_cols)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[tuple, list] = {}
        types = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, values = batch.columns[:n_by], batch.columns[n_by:]
            types = [k.type for k in keys]
            x = np.stack([v.fill_null(0.0).to_numpy(zero_copy_only=False) for v in values], 1)
            known = np.stack([v.is_valid().to_numpy(zero_copy_only=False) for v in values], 1)
            group = np.zeros(len(x), np.int64)
            for k in keys:
                codes = k.dictionary_encode(null_encoding="encode").indices.to_numpy()
                group = np.unique(group * (codes.max() + 1) + codes, return_inverse=True)[1]
            for i in range(0, n_cols, _MASK_BITS):
                bits = known[:, i:i + _MASK_BITS]
                mask = bits @ (1 << np.arange(bits.shape[1], dtype=np.int64))
                group = np.unique((group << _MASK_BITS) + mask, return_inverse=True)[1]
            firsts = np.unique(group, return_index=True)[1]
            for g, first in enumerate(firsts.tolist()):
                here = known[first]
                rows = x[group == g][:, here] if len(firsts) > 1 else x[:, here]
                key = (*[k[first].as_py() for k in keys], here.tobytes())
                if key not in state:
                    state[key] = [here, rows[0], 0, np.zeros(here.sum()),
                                  np.zeros((here.sum(), here.sum()))]
                s, n = state[key], len(rows)
                with np.errstate(invalid="ignore", over="ignore"):  # infinities give NaN
                    off = rows - s[1]
                    mean = off.mean(0)
                    off -= mean
                    delta, total = mean - s[3], s[2] + n
                    s[4] += off.T @ off + np.outer(delta, delta) * (s[2] * n / total)
                    s[3] += delta * (n / total)
                s[2] = total
        for key, (here, origin, n, mean, products) in state.items():
            at = np.flatnonzero(here)
            means, c = np.full(n_cols, np.nan), np.full((n_cols, n_cols), np.nan)
            means[at], c[np.ix_(at, at)] = origin + mean, products
            absent = ~(here[a] & here[b])
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([k] * len(a), t) for k, t in zip(key, types)],
                 pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                 pa.array(np.where(absent, 0, n), pa.int64()),
                 *[pa.array(v, pa.float64(), mask=absent) for v in (
                     means[a], means[b], c[a, a], c[b, b], c[a, b])]],
                names=[*by, "_kc_a", "_kc_b", "_kc_n", "_kc_ma", "_kc_mb", "_kc_va", "_kc_vb",
                       "_kc_c"])

    return place
