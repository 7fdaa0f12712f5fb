"""Dense integer codes shared by the training and test data.

The dictionary of a column is the distinct values of train and test
together (null kept as a value).  Codes are 0..n-1 in a fixed order: null
first, then byte order of the strings, so two runs give the same codes.

Scale: the dictionary is built with ``distinct`` (partial aggregation) and
numbered by ``running_index`` without a group, i.e. a range partition plus
a per-partition offset table of at most ``spark.sql.shuffle.partitions``
rows; no single task sorts the whole dictionary.  Codes are attached with a
null-safe equi join; AQE broadcasts the dictionary only when its measured
size allows it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookup import attach, key_counts
from .sequence import materialize, running_index

#: Slots are counted by an int.
MOST_SLOTS = 2**31 - 1


def key_dictionary(frames: Sequence[DataFrame], col: str) -> DataFrame:
    """Distinct values of ``col`` over all frames (union all, then distinct)."""
    it = iter(frames)
    acc = next(it).select(col)
    for f in it:
        acc = acc.unionByName(f.select(col))
    return acc.distinct()


def code_dictionary(frames: Sequence[DataFrame], col: str, code_col: str = "code") -> DataFrame:
    """``(col, code)`` with code 0..n-1, null first, then ascending."""
    d = key_dictionary(frames, col)
    ranked = running_index(d, [], [F.col(col).asc_nulls_first()], "_kc_pos")
    return ranked.select(col, (F.col("_kc_pos") - 1).cast("bigint").alias(code_col))


def code_dictionaries(frame: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(feature, value, n_rows, code)`` for several string columns in one pass.

    One aggregate over the stacked columns and one numbering grouped by
    feature; a huge dictionary (say students) is still cut across tasks.
    """
    d = key_counts(frame, cols)
    ranked = running_index(d, ["feature"], [F.col("value").asc_nulls_first()], "_kc_pos")
    return ranked.select("feature", "value", "n_rows",
                         (F.col("_kc_pos") - 1).cast("bigint").alias("code"))


def encode(df: DataFrame, dictionary: DataFrame, col: str, code_col: str = "code",
           out: str | None = None) -> DataFrame:
    """Replace ``col`` by its code (kept name unless ``out`` is given)."""
    out = out or col
    d = dictionary.select(F.col(col).alias("_kc_key"), F.col(code_col).alias("_kc_code"))
    joined = df.join(d, F.col(col).eqNullSafe(F.col("_kc_key")), "left")
    cols = [F.col("_kc_code").alias(out) if c == col else F.col(c) for c in df.columns]
    if out != col:
        cols = [F.col(c) for c in df.columns] + [F.col("_kc_code").alias(out)]
    return joined.select(*cols)


def encode_all(df: DataFrame, dictionaries: DataFrame, cols: Sequence[str],
               row_key: Sequence[str] = ()) -> DataFrame:
    """Replace several columns by their codes from ``code_dictionaries``, all
    large dictionaries in one lookup (``lookup.attach``)."""
    dims = materialize(dictionaries, "dictionaries", ["feature"])
    found = attach(df, dims, cols, ["code"], row_key)
    return found.select(*[F.col(f"_kc_{c}_code").alias(c) if c in cols else F.col(c)
                          for c in df.columns])


def one_hot_long(df: DataFrame, id_cols: Sequence[str], coded_cols: Sequence[str]) -> DataFrame:
    """Long form of a one-hot matrix: one ``(ids..., feature, code)`` row per set bit.

    A null code (a missing value) keeps its own column, like ``dummy_na``.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("bigint").alias("code"))
                      for c in coded_cols])
    return df.select(*id_cols, F.inline(pairs))


def one_hot_vectors(df: DataFrame, coded_cols: Sequence[str], out: str = "one_hot") -> DataFrame:
    """One sparse vector per row: a slot per code of each column, in the order
    of the columns.  Codes are 0..n-1 with the missing value as a code of its
    own, so it keeps a slot (no column per value).

    Only the largest code of each column comes to the driver.  MLlib's
    ``OneHotEncoder`` and ``VectorAssembler`` would name every slot in the metadata
    of their columns, and so hold the whole dictionary there.
    """
    codes = [F.col(c).cast("double") for c in coded_cols]
    found = df.agg(*[F.max(c) for c in codes], F.count_if(reduce(
        or_, [c.isNull() | F.isnan(c) | (c < 0) | (c != F.floor(c)) for c in codes]))).first()
    *largest, wrong = found
    if wrong:
        raise ValueError(f"{wrong} rows have a code that is missing or no whole number from 0")
    starts = list(accumulate((int(n or 0) + 1 for n in largest), initial=0))
    if starts[-1] > MOST_SLOTS:
        raise ValueError(f"{starts[-1]} slots are more than a vector can have")
    names, total, k = VectorUDT.sqlType().names, starts[-1], len(codes)

    @F.arrow_udf(VectorUDT())
    def vectors(slots: pa.Array) -> pa.Array:
        """The fields of sparse vectors (type 0), which is how rows hold them."""
        n = len(slots)
        ends = pa.array(np.arange(n + 1, dtype=np.int32) * k)
        fields = (pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, total, np.int32)),
                  pa.ListArray.from_arrays(ends, slots.flatten()),
                  pa.ListArray.from_arrays(ends, pa.array(np.ones(n * k))))
        return pa.StructArray.from_arrays(fields, names=names)

    slots = F.array(*[(c + n).cast("int") for c, n in zip(codes, starts)])
    return df.select(*[c for c in df.columns if c != out], vectors(slots).alias(out))


def vector_indices(col: str) -> Column:
    """Positions of the non-zero entries of a vector column."""
    v = F.unwrap_udt(F.col(col))
    places = F.transform(v["values"], lambda x, i: F.when(x != 0, i))
    return F.coalesce(v["indices"], F.filter(places, lambda i: i.isNotNull()))
