"""N-gram Jaccard join over size-banded tiles with bitmap signatures.

Two documents link when their sets of five-word shingles have a Jaccard
similarity of PERCENT / 100 or more; `component_id` is the smallest id
reachable over links.  No link between different texts is missed:

1. Documents with equal sets form one class, represented by the smallest id.
2. A set's shingles are ordered, frequent ones last (by a sketch of counts
   over all documents), and the first n - ceil(0.75 n) + 1 are its tokens:
   similar sets share at least one.  Sets are dealt out by token, with the
   token's place in the order.
3. In a token's group, all sets are first compared with the one of the
   smallest id.  What that links forms preliminary components; a large group
   of near copies collapses here at a cost proportional to its size.
4. Groups are compared in tiles.  A tile is a group, or, for a group of more
   than TILE_ROWS sets, a part of it: sets of one size band with those of
   the same and the next band (sizes beyond 0.75 cannot link), a large band
   in blocks by hash.  A tile gives the pairs of different components whose
   sizes fit and whose sets are long enough after the token: at the first
   token that two sets share, all they share is still to come.  A pair with
   an equal token among the EARLIER shared ones before this token is left to
   that token's group.
5. Pairs are bounded by signatures before sets are touched: a set's hashes
   are thrown onto a bitmap of at least twice its size, and each bit that
   only one bitmap has stands for a shingle the other set lacks.  What can
   still reach the limit is counted exactly on the sorted arrays.

Defined results: texts without words have an empty set and no link; a null
doc_id comes after all others; rows that share a doc_id, or have none, and
differ in text are one node each, joined only if their sets link (`nodes`):
the row's component is that of its own set; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kcflow.llm.bloom import contains, filter_bits, once_filter
from kcflow.llm.common import BATCH_ROWS, LAST_ID, arrow_batches, id_key, materialise, packed
from kcflow.llm.graph import components
from kcflow.llm.numbering import gapless
from kcflow.llm.shingle_sets import by_part
from kcflow.llm.suffix_dedup import mix

PERCENT = 75
#: Counters of the sketch that orders shingles by frequency: one for so many bytes of
#: text, within bounds (a byte each when broadcast).
BYTES_PER_COUNTER = 64
MIN_COUNTERS, MAX_COUNTERS = 1 << 16, 1 << 24
SEGMENTS = 64
#: Sets of a token compared in one task as one tile.
TILE_ROWS = 20_000
#: Earlier shared tokens of its set that a tile's row carries.
EARLIER = 4


def _signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


SET_SCHEMA = "d long, n long, hi long, lo long, v long, seg int, counts binary"


def set_table(texts: DataFrame, counters: int) -> DataFrame:
    """Of rows (d, text, v): set size and a 128-bit hash of the set.

    The same pass counts how many sets' shingles fall on each of the
    counters; those rows have a segment number instead of a document (counts
    of one task stop at 255, which orders shingles as well).
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(counters, np.uint8)
        for batch in batches:
            n, hi, lo = [], [], []
            for _, found in by_part(batch.column(1)):
                for s in found:
                    digest = xxhash.xxh3_128_intdigest(s.tobytes())
                    n.append(s.size)
                    hi.append(_signed(digest >> 64))
                    lo.append(_signed(digest & (1 << 64) - 1))
                at, times = np.unique(np.concatenate(found) & np.uint64(counters - 1),
                                      return_counts=True)
                at = at.astype(np.int64)
                total[at] = np.minimum(total[at] + times, 255)
            none = pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(hi, pa.int64()),
                 pa.array(lo, pa.int64()), batch.column(2), *none], names=names)
        size = counters // SEGMENTS
        for k in range(SEGMENTS):
            part = total[k * size:(k + 1) * size]
            if part.any():
                none = [pa.nulls(1, pa.int64())] * 5
                yield pa.RecordBatch.from_arrays(
                    [*none, pa.array([k], pa.int32()), pa.array([part.tobytes()], pa.binary())],
                    names=names)

    names = [c.split()[0] for c in SET_SCHEMA.split(", ")]
    return texts.mapInArrow(sets, SET_SCHEMA)


def summed_counts(parts: DataFrame, counters: int) -> np.ndarray:
    """All tasks' counters added up, from rows (seg, counts)."""
    size = counters // SEGMENTS

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        for batch in batches:
            for seg, counts in zip(*batch.columns, strict=True):
                if seg.as_py() != now:
                    if now is not None:
                        yield segment(now, total)
                    now, total = seg.as_py(), np.zeros(size, np.uint64)
                total += np.frombuffer(counts.as_buffer(), np.uint8)
        if now is not None:
            yield segment(now, total)

    def segment(seg, total):
        counts = np.minimum(total, 65535).astype(np.uint16).tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([seg], pa.int32()), pa.array([counts], pa.binary())],
            names=["seg", "counts"])

    out = np.zeros(counters, np.uint16)
    rows = parts.repartition(SEGMENTS, "seg").sortWithinPartitions("seg").mapInArrow(
        merge, "seg int, counts binary").collect()  # SEGMENTS rows, 2 * MAX_COUNTERS bytes at most
    while rows:
        row = rows.pop()
        out[row.seg * size:(row.seg + 1) * size] = np.frombuffer(row.counts, np.uint16)
    return out


def frequency_classes(counts: np.ndarray) -> np.ndarray:
    """Per counter 0 for usual counts, more for each doubling above twice the median."""
    sizes = np.bincount(counts, minlength=65536)
    sizes[0] = 0
    usual = max(1, int(np.searchsorted(np.cumsum(sizes), sizes.sum() / 2)))
    of_count = np.ceil(np.log2(np.maximum(np.arange(65536), 1) / (2 * usual)))
    return np.clip(of_count, 0, 31).astype(np.uint8)[counts]


def tokens(s: np.ndarray, classes: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a set in the order that puts frequent ones last."""
    least = -(-percent * s.size // 100)  # shared with any similar set
    order = np.lexsort((s, classes[s & np.uint64(classes.size - 1)]))
    return s[order[:s.size - least + 1]]


def token_rows(texts: DataFrame, chosen, classes, percent: int) -> DataFrame:
    """(token, n, d, pos) of all sets; pos: the token's place in its set."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            use = contains(chosen.value, mix(ids))
            for lo, found in by_part(batch.column(1), use):
                some = [(lo + i, s) for i, s in enumerate(found) if s.size]
                if not some:
                    continue
                own = [tokens(s, classes.value, percent) for _, s in some]
                k = np.array([t.size for t in own])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(own).view(np.int64)),
                     pa.array(np.repeat([s.size for _, s in some], k).astype(np.int64)),
                     pa.array(np.repeat(ids[[i for i, _ in some]], k)),
                     pa.array(np.concatenate([np.arange(t.size) for t in own]), pa.int32())],
                    names=["token", "n", "d", "pos"])

    return texts.mapInArrow(emit, "token long, n long, d long, pos int")


STAR_SCHEMA = "token long, d long, n long, pos int, first long, n_first long, pos_first int"


def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (token, d, n, pos) in order, without those alone with their token; `first`,
    `n_first` and `pos_first` are of the first row of the group (null on itself)."""
    head, held = None, None  # the group's first row, as long as no second has come; its values
    for batch in batches:
        rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not rows[0].size:
            continue
        if head is not None:  # decide on it together with this batch
            rows = [np.concatenate((h, x)) for h, x in zip(head, rows, strict=True)]
        token = rows[0]
        fresh = np.concatenate(([True], token[1:] != token[:-1]))
        start = np.maximum.accumulate(np.where(fresh, np.arange(token.size), 0))
        first = [x[start] for x in rows[1:]]
        own = fresh.copy()
        if head is None and held is not None and held[0] == token[0]:
            begun = start == 0  # these go on with the group of the batch before
            for x, value in zip(first, held[1:], strict=True):
                x[begun] = value
            own[0] = False
        # a first row is kept if a second follows
        keep = ~own | np.concatenate((token[1:] == token[:-1], [False]))
        held = token[-1], *(x[-1] for x in first)
        head = [x[-1:] for x in rows] if own[-1] else None
        if keep.any():
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(x[keep]) for x in rows],
                 *[pa.array(x[keep], mask=own[keep]) for x in first]],
                names=[c.split()[0] for c in STAR_SCHEMA.split(", ")])


def signature(s: np.ndarray) -> bytes:
    """A bitmap of the hashes: a power of two of bits, at least twice their number."""
    bits = max(64, 1 << int(2 * s.size - 1).bit_length())
    at = (s >> np.uint64(20)) & np.uint64(bits - 1)
    out = np.zeros(bits, np.uint8)
    out[at.astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").tobytes()


def overlap_bound(a: bytes, b: bytes, n_a: int, n_b: int) -> int:
    """At most so many shingles are shared: bits of one bitmap alone are others."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while x.size > y.size:  # fold the longer: the lower bits of a position stay
        x = x[:x.size // 2] | x[x.size // 2:]
    while y.size > x.size:
        y = y[:y.size // 2] | y[y.size // 2:]
    return min(n_a - int(np.bitwise_count(x & ~y).sum()),
               n_b - int(np.bitwise_count(y & ~x).sum()))


def similar(shared: int, n_a: int, n_b: int, percent: int) -> bool:
    return 100 * shared >= percent * (n_a + n_b - shared)


def linked(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar: signatures first, then arrays."""
    sc = pairs.sparkSession.sparkContext
    needed = pairs.select(F.explode(F.array("a", "b")).alias("d")).distinct()
    wanted = sc.broadcast(once_filter(needed, lambda b: mix(
        b.column(0).to_numpy(zero_copy_only=False)), filter_bits(2 * pairs.count())))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            use = contains(wanted.value, mix(ids))
            for lo, found in by_part(batch.column(1), use):
                some = [(int(ids[lo + i]), s.size, signature(s), s.tobytes())
                        for i, s in enumerate(found) if s.size]
                if some:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*some, strict=True), (
                            pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
                        names=["d", "n", "bits", "hashes"])

    table = materialise(texts.mapInArrow(
        sets, "d long, n long, bits binary, hashes binary"), "sets")
    wanted.destroy()  # the table is written

    @F.pandas_udf("boolean")
    def may(x: pd.Series, y: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series([similar(overlap_bound(a, b, i, j), i, j, percent)
                          for a, b, i, j in zip(x, y, n, m, strict=True)], dtype=bool)

    @F.pandas_udf("boolean")
    def are(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(x, y, strict=True):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            shared = np.intersect1d(a, b, assume_unique=True).size
            out.append(similar(shared, a.size, b.size, percent))
        return pd.Series(out, dtype=bool)

    def side(name: str, column: str) -> DataFrame:
        return table.select(F.col("d").alias(name), F.col("n").alias(f"n_{name}"),
                            F.col(column).alias(f"{column}_{name}"))

    possible = materialise(
        pairs.join(side("a", "bits"), "a").join(side("b", "bits"), "b")
        .where(may("bits_a", "bits_b", "n_a", "n_b")).select("a", "b").distinct(), "possible")
    return possible.join(side("a", "hashes"), "a").join(side("b", "hashes"), "b").where(
        are("hashes_a", "hashes_b")).select("a", "b").distinct()


def tile_pairs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of different components that may link, per tile.

    Rows are (token, band, i, j, own, block, n, d, pos, label, earlier tokens) ordered by
    tile; `own` tells sets of the tile's band from those of the next one.  Two sets that
    share an earlier token meet in its tile, where they have more to come than here.
    """

    def compare_few(rows, token, i, j):
        a, b = [], []
        for own, block, n, d, pos, label, *before in rows:
            if not own or block != i:
                continue
            met = {x for x in before if x != token}
            for own_2, block_2, n_2, d_2, pos_2, label_2, *before_2 in rows:
                if (label_2 != label and block_2 == j and (not own_2 or i != j or d_2 > d)
                        and 100 * min(n, n_2) >= percent * max(n, n_2)
                        and (100 + percent) * min(n - pos, n_2 - pos_2) >= percent * (n + n_2)
                        and met.isdisjoint(before_2)):
                    a.append(d)
                    b.append(d_2)
        if a:
            yield np.array(a), np.array(b)

    def compare(rows, token, i, j):
        own, block, n, d, pos, label, *before = (np.array(c) for c in zip(*rows, strict=True))
        before = np.stack(before)
        own = own.astype(bool)
        for k in np.flatnonzero(own & (block == i)):
            # its own band once, and the next band
            ok = (label != label[k]) & (block == j) & (
                ~own | ((d > d[k]) if i == j else np.ones(d.size, bool)))
            lo, hi = np.minimum(n, n[k]), np.maximum(n, n[k])
            rest = np.minimum(n - pos, n[k] - pos[k])
            ok &= (100 * lo >= percent * hi) & ((100 + percent) * rest >= percent * (n + n[k]))
            for x in before[:, k][before[:, k] != token]:
                ok &= (before != x).all(axis=0)
            if ok.any():
                yield np.full(int(ok.sum()), d[k]), d[ok]

    pending, size = [], 0

    def flush():
        a, b = (np.concatenate(x) for x in zip(*pending, strict=True))
        pairs = np.unique(np.stack((np.maximum(a, b), np.minimum(a, b)), axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])],
                                          names=["a", "b"])

    for (token, _, i, j), rows in _tiles(batches):
        if len({row[5] for row in rows}) < 2:
            continue  # one component
        for a, b in (compare_few if len(rows) <= 16 else compare)(rows, token, i, j):
            pending.append((a, b))
            size += a.size
            if size >= 200_000:
                yield flush()
                pending, size = [], 0
    if pending:
        yield flush()


def _tiles(batches: Iterator[pa.RecordBatch]):
    tile, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:4] != tile:
                if len(rows) > 1:
                    yield tile, rows
                tile, rows = row[:4], []
            rows.append(row[4:])
    if len(rows) > 1:
        yield tile, rows


EARLIER_COLUMNS = [f"before_{k}" for k in range(1, EARLIER + 1)]
TILE_COLUMNS = ["token", "band", "i", "j", "own", "block", "n", "d", "pos", "label",
                *EARLIER_COLUMNS]


def tiles(labelled: DataFrame, percent: int) -> DataFrame:
    """Rows (token, n, d, pos, label, earlier tokens) dealt to tiles (see the module docstring)."""
    large = materialise(labelled.groupBy("token").agg(F.count(F.lit(1)).alias("rows"))
                        .where(F.col("rows") > TILE_ROWS).select("token"), "large-groups")
    zero = F.lit(0).cast("long")
    whole = labelled.join(large, "token", "left_anti").withColumns({
        "band": F.lit(-1).cast("long"), "i": zero, "j": zero, "own": F.lit(1), "block": zero})
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(100.0 / percent)) + 1e-9)
    banded = labelled.join(large, "token").withColumn("band", band)
    width = banded.groupBy("token", "band").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(TILE_ROWS)).alias("blocks"))
    above = width.select("token", (F.col("band") - 1).alias("band"), F.col("blocks").alias("above"))
    # as many blocks as the larger of a tile's two bands needs
    blocks = width.join(above, ["token", "band"], "left").select(
        "token", "band", F.greatest("blocks", F.coalesce("above", F.lit(1))).alias("blocks"))
    dealt = banded.withColumn("own", F.lit(1)).unionByName(
        banded.withColumn("band", F.col("band") - 1).withColumn("own", F.lit(0))) \
        .join(blocks, ["token", "band"]).withColumn(
            "block", F.pmod(F.xxhash64("d"), F.col("blocks")))
    every = F.sequence(zero, F.col("blocks") - 1)
    # block i of the tile's own band meets block j of its own (i <= j) and of the next band
    left = dealt.where("own = 1").select("*", F.col("block").alias("i"), F.explode(every).alias("j"))
    right = dealt.select("*", F.explode(every).alias("i"), F.col("block").alias("j")).where(
        "own = 0 OR i < j")
    return reduce(DataFrame.unionByName, [x.select(TILE_COLUMNS) for x in (whole, left, right)])


def nodes(pairs: DataFrame) -> DataFrame:
    """(d, v, node): numbers of their own for texts whose id has other texts as well.

    A text alone with its id has the id as its node, and no row here.  The numbers lie
    beyond all ids; if there is no room for them, all texts are numbered from 0.
    """
    pairs = pairs.distinct()
    ids = materialise(pairs.groupBy("d").agg(F.count(F.lit(1)).alias("texts")), "ids")
    usual = F.col("d") != LAST_ID
    lo, hi, n = ids.agg(F.min(F.when(usual, F.col("d"))), F.max(F.when(usual, F.col("d"))),
                        F.sum(F.when(F.col("texts") > 1, F.col("texts")))).first()
    n, base = n or 0, 0 if hi is None else hi + 1
    several = pairs.join(ids.where("texts > 1"), "d", "left_semi")
    if base + n >= LAST_ID:
        base = lo - n
        if base < -2**63:
            several, base, n = pairs, 0, None
    return materialise(gapless(several, [], ["d", "v"], "node", n).select(
        "d", "v", (F.col("node") + F.lit(base)).alias("node")), "nodes")


def similar_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   percent: int = PERCENT) -> DataFrame:
    """`row` (the input row as a struct), d (its id as a long, null as the last),
    v (a hash of its text), n_shingles, component (the smallest d of its group) and
    component_v (v of the text that stands for the group; its d is the component)."""
    rows = docs.select(packed(docs).alias("row"), id_key(doc_id).alias("d"),
                       F.col(f"`{text}`").alias("text"), F.xxhash64(f"`{text}`").alias("v"))
    # all work in Python is done in here; the join below is Spark's alone
    with arrow_batches(docs.sparkSession, BATCH_ROWS):
        groups = _groups(rows, percent)
    return rows.select("row", "d", "v").join(groups, ["d", "v"]).select(
        "row", "d", "v", "n_shingles", "component", "component_v")


def _groups(rows: DataFrame, percent: int) -> DataFrame:
    """(d, v, n_shingles, component, component_v) of rows (d, text, v)."""
    spark = rows.sparkSession
    sc = spark.sparkContext
    texts = rows.select("d", "text", "v")

    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    counters = min(MAX_COUNTERS, max(MIN_COUNTERS, 1 << (size // BYTES_PER_COUNTER).bit_length()))
    hashed = materialise(set_table(texts, counters), "set-hashes")
    own = nodes(hashed.where("seg IS NULL").select("d", "v"))
    several = own.count() > 0

    def with_nodes(table: DataFrame) -> DataFrame:
        if not several:
            return table.withColumn("node", F.col("d"))
        return table.join(own, ["d", "v"], "left").withColumn("node", F.coalesce("node", "d"))

    sets = with_nodes(hashed.where("seg IS NULL"))
    classes = materialise(sets.where("n > 0").groupBy("n", "hi", "lo").agg(
        F.min("node").alias("first")), "classes")
    member = materialise(sets.join(classes, ["n", "hi", "lo"], "left").select(
        "d", "v", "n", F.coalesce("first", "node").alias("first")).distinct(), "members")
    texts = with_nodes(texts).select(F.col("node").alias("d"), "text")  # from here on d: the node
    chosen = sc.broadcast(once_filter(classes.select("first"), lambda b: mix(
        b.column(0).to_numpy(zero_copy_only=False)), filter_bits(classes.count())))
    frequency = sc.broadcast(frequency_classes(summed_counts(
        hashed.where("seg IS NOT NULL").select("seg", "counts"), counters)))

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = materialise(
        token_rows(texts, chosen, frequency, percent)
        .select("token", "d", "n", "pos")
        .repartition(parts, "token").sortWithinPartitions("token", "d")
        .mapInArrow(stars, STAR_SCHEMA), "shared-tokens")
    chosen.destroy()
    frequency.destroy()
    fits = (F.least("n", "n_first") * 100 >= F.greatest("n", "n_first") * percent) & (
        (100 + percent) * F.least(F.col("n") - F.col("pos"), F.col("n_first") - F.col("pos_first"))
        >= percent * (F.col("n") + F.col("n_first")))
    first_pairs = materialise(_pairs(shared.where(F.col("first").isNotNull() & fits)
                                     .select("d", F.col("first").alias("e"))), "pairs")
    first_links = materialise(linked(first_pairs, texts, percent), "links")

    label = materialise(components(first_links), "labels")
    # where a set has fewer earlier tokens, the row's own stands for none
    in_order = Window.partitionBy("d").orderBy("pos")
    followed = shared.select("token", "n", "d", "pos", *[
        F.lag("token", k).over(in_order).alias(c) for k, c in enumerate(EARLIER_COLUMNS, 1)])
    labelled = followed.withColumns({c: F.coalesce(c, "token") for c in EARLIER_COLUMNS}).join(
        label.withColumnRenamed("node", "d"), "d", "left").withColumn(
            "label", F.coalesce("component", "d"))
    order = TILE_COLUMNS[:4]
    second = (tiles(labelled, percent).repartition(parts, *order).sortWithinPartitions(*order)
              .mapInArrow(lambda batches: tile_pairs(batches, percent), "a long, b long"))
    second_pairs = materialise(_pairs(second.select(F.col("a").alias("d"), F.col("b").alias("e")))
                               .join(first_pairs, ["a", "b"], "left_anti"), "tile-pairs")
    second_links = linked(second_pairs, texts, percent)

    merged = components(label.select(F.col("node").alias("a"), F.col("component").alias("b"))
                        .where("a != b").union(second_links))
    grouped = materialise(
        member.join(merged.withColumnRenamed("node", "first"), "first", "left").select(
            "d", "v", F.col("n").alias("n_shingles"),
            F.coalesce("component", "first").alias("group")), "grouped")
    least = materialise(grouped.groupBy("group").agg(
        F.min(F.struct("d", "v")).alias("least")), "least")
    return grouped.join(least, "group").select(
        "d", "v", "n_shingles", F.col("least.d").alias("component"),
        F.col("least.v").alias("component_v"))


def _pairs(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("d", "e").alias("a"), F.least("d", "e").alias("b")) \
        .where("a != b").distinct()
