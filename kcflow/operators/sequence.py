"""Running numbers and exact order statistics that survive hot keys.

A window ``partitionBy(group).orderBy(...)`` sends every row of a group to
one task, so a group holding a third of the data becomes one straggler.
Here rows are range-partitioned on (group, order) instead: a hot group is
cut into many slices, each slice numbers (or sums) its own rows, and a small
table supplies the offset of every slice.  A numbering needs offsets only for
the first group of a slice (all others begin inside it), so its table has one
row per slice and the numbered rows are shuffled once.  Quantiles keep one row
per group per slice it touches, so the only window over a whole group runs over
that table, never over the data.  Only a numbering whose caller has measured that
no group is larger than a slice (``largest``) takes the plain window, in the layout
that the rows have already.

Requirement: ``order_cols`` must make the order total within a group when
the exact number of each row matters (ties get consecutive numbers in an
unspecified order).  Rows equal in group and order fall into one slice, so
quantiles, whose input may have many equal values, count equal values first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import default_partitions, scratch_path

_PID, _MID, _N, _LO, _OFF = "_kc_pid", "_kc_mid", "_kc_n", "_kc_lo", "_kc_off"
_IN, _ALL = "_kc_in", "_kc_all"
#: Of the written tables: they are written once and read a few times.
COMPRESSION = "zstd"
# ``monotonically_increasing_id``: the lower bits are the place in the partition
_PLACE_BITS = (1 << 33) - 1
#: Rows of a group that one task may order by itself: the rows of a slice.
WHOLE_GROUP_ROWS = 1_000_000


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as parquet below the shared checkpoint folder and read it back.

    ``partition_by`` lays the files out by those columns, so later filters
    on them prune whole folders.
    """
    path = scratch_path(df.sparkSession, name)
    w = df.write.mode("error").option("compression", COMPRESSION)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def sliced(df: DataFrame, keys: Sequence[Column], num_partitions: int | None = None,
           keep: Sequence[str] | None = None, deal: Sequence[Column] | None = None,
           inside: Sequence[str] = (), size: str | None = None) -> DataFrame:
    """The rows range-partitioned and sorted by ``keys``, with the slice and
    the position in the whole table (ascending inside a slice).

    ``keep`` names the columns that are written (all by default): what only
    the order needs can go.  ``deal`` replaces the keys that the rows are dealt
    by, for keys too long to be sampled: short forms in the same order.
    ``inside`` names kept columns that the keys begin with, and adds the
    position of each row among those of its slice that are equal in them;
    ``size``, a column of whole numbers above 0, gives running sums of it instead,
    in those rows and in the slice.

    Range bounds come from sampling, and Catalyst would plan the exchange
    once per branch that reads it, so the slices are written once in the
    shared checkpoint folder: every branch reads the same cut, and a lost
    executor re-reads files instead of sampling again.
    """
    n = num_partitions or default_partitions(df.sparkSession)
    ordered = df.repartitionByRange(n, *(deal or keys)).sortWithinPartitions(*keys)
    placed = ordered.select(*(keep or df.columns), F.spark_partition_id().alias(_PID),
                            F.monotonically_increasing_id().alias(_MID))
    if inside or size:
        added = [_IN, _ALL] if size else [_IN]
        placed = placed.mapInArrow(_positions(inside, size), StructType(
            [*placed.schema.fields, *[StructField(c, LongType()) for c in added]]))
    return materialize(placed, "ranged")


def _positions(groups: Sequence[str], size: str | None = None
               ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds to sorted rows the position, from 1, in their run of equal ``groups``
    (nulls are equal, and so are NaNs and zeros of either sign, as in Spark), or the
    sums of ``size`` up to each row in its run and in the slice."""
    groups = list(groups)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the last row's groups, the sum up to it, and the sum before its run
        before, total, begun = {}, 0, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            starts = np.zeros(n, bool)
            starts[0] = not before
            for g in groups:
                x = batch.column(batch.schema.get_field_index(g))
                if pa.types.is_floating(x.type):
                    x = pc.add(x, pa.scalar(0.0, x.type))
                both = pa.concat_arrays([before[g], x]) if g in before else x
                codes = both.dictionary_encode(null_encoding="encode").indices.to_numpy()
                starts[n - len(codes) + 1:] |= codes[1:] != codes[:-1]
                before[g] = x.slice(n - 1)
            sizes = np.ones(n, np.int64) if size is None else batch.column(
                batch.schema.get_field_index(size)).to_numpy()
            sums = np.cumsum(sizes) + total
            runs = np.maximum.accumulate(np.where(starts, sums - sizes, begun))
            total, begun = int(sums[-1]), int(runs[-1])
            added = {_IN: pa.array(sums - runs, pa.int64())}
            if size is not None:
                added[_ALL] = pa.array(sums, pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, *added.values()],
                                             names=[*batch.schema.names, *added])

    return place


def _slice_offsets(ranged: DataFrame, group_cols: Sequence[str], size: Column,
                   total_col: str | None) -> DataFrame:
    """Per (slice, group): offset from the earlier slices, first position, and
    the group's total; key columns renamed for the join."""
    slices = ranged.groupBy(_PID, *group_cols).agg(size.alias(_N), F.min(_MID).alias(_LO))
    before = Window.partitionBy(*group_cols).orderBy(_PID).rowsBetween(
        Window.unboundedPreceding, -1)
    out = slices.withColumn(_OFF, F.coalesce(F.sum(_N).over(before), F.lit(0)))
    if total_col:
        out = out.withColumn(total_col, F.sum(_N).over(Window.partitionBy(*group_cols))
                             .cast("bigint"))
    out = out.withColumnsRenamed({_PID: "_kc_pid2", **{
        g: f"_kc_g{i}" for i, g in enumerate(group_cols)}}).drop(_N)
    # without groups there is one row per slice: a bound, so broadcast
    return out if group_cols else F.broadcast(out)


def _with_offsets(ranged: DataFrame, offsets: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    cond = [F.col(_PID) == F.col("_kc_pid2")] + [
        F.col(g).eqNullSafe(F.col(f"_kc_g{i}")) for i, g in enumerate(group_cols)]
    return ranged.join(offsets, cond, "inner")


def _first_offsets(ranged: DataFrame, group_cols: Sequence[str], place: Column,
                   is_first: Column) -> DataFrame:
    """Per slice: the last place of its first group in earlier slices (a row per slice)."""
    group = F.struct(*group_cols) if group_cols else F.lit(0)
    ends = ranged.groupBy(_PID).agg(
        F.min_by(group, _MID).alias("first"), F.max(F.when(is_first, place)).alias("n_first"),
        F.max_by(group, _MID).alias("last"), F.max_by(place, F.col(_MID)).alias("n_last"),
        F.max_by(is_first, F.col(_MID)).alias("one"))

    def end(g: str, n: str, first: bool) -> Column:
        return F.struct(F.col(g).alias("g"), F.col(n).alias(_N), F.lit(first).alias("is_first"))

    # a slice with one group has one end only
    edges = ends.select(F.col(_PID).alias("_kc_pid2"), F.inline(F.when(
        F.col("one"), F.array(end("first", "n_first", True))).otherwise(
            F.array(end("first", "n_first", True), end("last", "n_last", False)))))
    before = Window.partitionBy("g").orderBy("_kc_pid2").rowsBetween(
        Window.unboundedPreceding, -1)
    return edges.withColumn(_OFF, F.coalesce(F.sum(_N).over(before), F.lit(0))).where(
        "is_first").select("_kc_pid2", _OFF)


def _placed(ranged: DataFrame, group_cols: Sequence[str], place: Column, in_slice: Column
            ) -> tuple[DataFrame, Column]:
    """The rows of the slices with the offset of their slice, and the place of a row
    in its group."""
    is_first = place == in_slice
    # one row per slice: a bound, so broadcast
    joined = ranged.join(F.broadcast(_first_offsets(ranged, group_cols, place, is_first)),
                         F.col(_PID) == F.col("_kc_pid2"))
    return joined, (place + F.when(is_first, F.col(_OFF)).otherwise(F.lit(0))).cast("bigint")


def running_index(df: DataFrame, group_cols: Sequence[str],
                  order_cols: Sequence[str | Column], out_col: str,
                  num_partitions: int | None = None,
                  group_count_col: str | None = None, keep: Sequence[str] | None = None,
                  deal: Sequence[Column] | None = None,
                  largest: int | None = None) -> DataFrame:
    """Add ``out_col``: 1-based position of each row inside its group.

    Same result as ``row_number().over(Window.partitionBy(group_cols)
    .orderBy(order_cols))``, but no task ever holds a whole group.
    ``group_count_col`` optionally adds the size of the group; ``keep`` and
    ``deal`` are those of ``sliced`` (the groups are always kept).

    The rows are shuffled once, into their slices: a slice numbers its groups
    while it is written, and only its first group can have begun before it.

    ``largest`` is a bound that was measured: no value of the first group column
    is in more rows.  Up to ``WHOLE_GROUP_ROWS`` such a value fits a slice, and the
    window numbers the rows where they are; rows that a join has dealt by that
    column are not moved or written at all.
    """
    group_cols = list(group_cols)
    kept = df.columns if keep is None else list(dict.fromkeys([*group_cols, *keep]))
    if largest is not None and largest <= WHOLE_GROUP_ROWS and group_cols:
        group = Window.partitionBy(*group_cols)
        return df.select(*kept, *([F.count(F.lit(1)).over(group).alias(group_count_col)]
                                  if group_count_col else []),
                         F.row_number().over(group.orderBy(*_cols(order_cols))).cast("bigint")
                         .alias(out_col))
    ranged = sliced(df, [*_cols(group_cols), *_cols(order_cols)], num_partitions, kept, deal,
                    group_cols)
    in_slice = F.col(_MID).bitwiseAND(F.lit(_PLACE_BITS)) + 1
    joined, pos = _placed(ranged, group_cols, F.col(_IN) if group_cols else in_slice, in_slice)
    if group_count_col:
        sizes = ranged.groupBy(*group_cols).agg(F.count(F.lit(1)).alias(group_count_col))
        sizes = sizes.withColumnsRenamed({g: f"_kc_g{i}" for i, g in enumerate(group_cols)})
        same = F.lit(True)
        for i, g in enumerate(group_cols):
            same = same & F.col(g).eqNullSafe(F.col(f"_kc_g{i}"))
        joined = joined.join(sizes if group_cols else F.broadcast(sizes), same)
    return joined.select(*[F.col(c) for c in kept],
                         *([group_count_col] if group_count_col else []), pos.alias(out_col))


def running_sum(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str | Column],
                size_col: str, out_col: str, num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col``: the sum of ``size_col`` (whole numbers above 0) over the rows
    of the group up to this one; the rows are cut and written as in ``running_index``."""
    group_cols = list(group_cols)
    ranged = sliced(df, [*_cols(group_cols), *_cols(order_cols)], num_partitions,
                    inside=group_cols, size=size_col)
    joined, upto = _placed(ranged, group_cols, F.col(_IN), F.col(_ALL))
    return joined.select(*df.columns, upto.alias(out_col))


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float],
                    group_cols: Sequence[str] = (), names: Sequence[str] | None = None,
                    num_partitions: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (the pandas/NumPy default).

    For n values sorted x[0..n-1] and probability q: h = (n-1) q,
    result = x[floor h] + (h - floor h) (x[floor h + 1] - x[floor h]).
    Nulls and NaNs are skipped.  Equal values are counted first (combined
    before the shuffle), so a value in a third of all rows is one row of the
    sorted table, and only group and value are moved.
    """
    group_cols = list(group_cols)
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    x, n, total = F.col("_kc_x"), F.col("_kc_c"), F.col("_kc_cnt")
    counts = df.where(F.col(value_col).isNotNull() & ~F.isnan(value_col)).select(
        *group_cols, F.col(value_col).cast("double").alias("_kc_x")).groupBy(
            *group_cols, "_kc_x").agg(F.count(F.lit(1)).alias("_kc_c"))
    ranged = sliced(counts, [*_cols(group_cols), x], num_partitions)
    offsets = _slice_offsets(ranged, group_cols, F.sum("_kc_c"), "_kc_cnt")
    inside = Window.partitionBy(_PID, *group_cols).orderBy(_MID).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    # ranks (from 0) of a value: from ``last - n`` to ``last - 1``
    ranked = _with_offsets(ranged.withColumn("_kc_run", F.sum("_kc_c").over(inside)), offsets,
                           group_cols).withColumn("_kc_last", F.col("_kc_run") + F.col(_OFF))
    aggs = [F.max("_kc_cnt").alias("_kc_cnt")]
    for i, p in enumerate(probs):
        h = F.floor((total - 1) * F.lit(float(p)))
        for name, rank in ((f"_kc_a{i}", h), (f"_kc_b{i}", h + 1)):
            holds = (rank < F.col("_kc_last")) & (rank >= F.col("_kc_last") - n)
            aggs.append(F.max(F.when(holds, x)).alias(name))
    picked = ranked.groupBy(*group_cols).agg(*aggs)
    outs = []
    for i, (p, name) in enumerate(zip(probs, names)):
        h = (total - 1) * F.lit(float(p))
        a, b = F.col(f"_kc_a{i}"), F.coalesce(F.col(f"_kc_b{i}"), F.col(f"_kc_a{i}"))
        outs.append((a + (h - F.floor(h)) * (b - a)).alias(name))
    return picked.select(*group_cols, *outs)


def systematic_counts(ranged: DataFrame, weight: str, draws: int, out: str,
                      start: float = 0.5) -> DataFrame:
    """How often each row is drawn by systematic sampling with its weight.

    ``ranged`` is a table of ``sliced`` (its order is the order of the draws).  The
    weights are laid end to end on a line of length ``draws``; a row is drawn for
    each of the points start, start + 1, ... in its piece, so its count is its
    expected number rounded up or down.  Running sums are taken inside the
    slices; there is one row per slice above them (a bound, so broadcast).
    """
    w = F.coalesce(F.col(weight).cast("double"), F.lit(0.0))
    inside = Window.partitionBy(_PID).orderBy(_MID).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    slices = ranged.groupBy(_PID).agg(F.sum(w).alias(_N))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = slices.select(F.col(_PID).alias("_kc_pid2"),
                            F.coalesce(F.sum(_N).over(before), F.lit(0.0)).alias(_OFF),
                            F.sum(_N).over(everything).alias("_kc_all"))
    placed = ranged.join(F.broadcast(offsets), F.col(_PID) == F.col("_kc_pid2")).withColumn(
        "_kc_end", F.sum(w).over(inside) + F.col(_OFF))

    def points(end: Column) -> Column:
        """Points before a place on the line of weights."""
        return F.ceil(F.try_divide(end * draws, F.col("_kc_all")) - start)

    # the end of a row is the start of the next one, to the last bit
    begin = F.coalesce(F.lag("_kc_end").over(Window.partitionBy(_PID).orderBy(_MID)), F.col(_OFF))
    return placed.withColumn(out, F.coalesce(
        points(F.col("_kc_end")) - points(begin), F.lit(0)).cast("bigint")).drop(
            "_kc_pid2", _OFF, "_kc_all", "_kc_end")
