"""Removal of byte strings that a document with a smaller id has too.

Every byte goes that lies in a string of LENGTH bytes which also starts in
a document with a smaller doc_id.  Strings are judged on the input.

No suffix array of a whole corpus fits a task, so the windows of LENGTH
bytes are dealt out by content.  Each window has an anchor, the GRAM bytes
in it with the smallest hash (the leftmost of equals).  Equal windows have
equal anchors; neighbouring windows mostly share one.  The windows of one
anchor form a segment, and:

1. Documents with equal text are represented by the smallest id; the others
   go as a whole (an aggregate per text hash).
2. A window has at least REACH bytes to the left or to the right of its
   anchor.  Two Bloom filters find the sides (an anchor with these bytes)
   that may occur in two documents; an aggregate per side confirms them.
3. Segments of confirmed sides (the windows on that side), each text once
   per batch with its smallest id, are shuffled by anchor.  Anchors with very many segments are split by
   window content, so no anchor is too large for a task.
4. Each task sorts the suffixes of its segments in two stages and reads
   equal windows off the adjacent common prefixes; the smallest id of a run
   of equal windows marks the windows of the others.
5. Marked windows are joined back to the occurrences and united per
   document.

Defined results: null texts are empty; texts shorter than LENGTH keep all
bytes; a null doc_id is one document after all others; rows that repeat a
doc_id count as the same document and remove nothing from each other; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kcflow.llm.bloom import contains, filter_bits, once_filter, twice_filter
from kcflow.llm.common import id_key, materialise, packed
from kcflow.llm.suffix_sort import common_prefixes, suffix_array, words_at

LENGTH = 50
GRAM = 20
#: Windows that can share an anchor.
SPREAD = LENGTH - GRAM + 1
#: Bytes on one side of an anchor that the filters tell apart.
REACH = (LENGTH - GRAM) // 2
#: Bits of the filters per side of an anchor (with one probe each).
BITS_PER_SIDE = 4
#: Bytes of text hashed at once; longer texts are taken in overlapping parts.
HASH_BYTES = 1 << 17
#: Bytes of segments sorted at once.
SORT_BYTES = 2 << 20
#: Different segments that a worker gathers before it hands them on.
MOST_SEGMENTS = 50_000
#: Anchors with more occurrences are split by window content.
SPLIT_ABOVE = 200_000

_BASE = 0x9E3779B97F4A7C15
_MASK24 = np.uint64((1 << 24) - 1)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def gram_hashes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the GRAM (16 + 4) bytes and of the 16 bytes from each position."""
    with np.errstate(over="ignore"):
        by_size, h, size = {}, text.astype(np.uint64) + np.uint64(1), 1
        while size < 16:
            by_size[size] = h
            h = h[:-size] * _power(size) + h[size:]
            size *= 2
        return _mixed(h[:-4] * _power(4) + by_size[4][16:]), h


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Anchors:
    """Segments of the documents text[starts:ends]: `doc`, `key` (hash of the anchor),
    `at` (the anchor), `first` and `last` window; `left` and `right`: hashes of the
    anchor with REACH bytes on that side, which count where a window has them."""

    def __init__(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        n = np.maximum(ends - starts - LENGTH + 1, 0)
        doc = np.repeat(np.arange(starts.size), n)
        if not doc.size:
            self.doc = self.at = self.first = self.last = np.zeros(0, np.int64)
            self.key = self.left = self.right = np.zeros(0, np.uint64)
            self.on_left = self.on_right = np.zeros(0, bool)
            return
        h, h16 = gram_hashes(text)
        low = (h & ~_MASK24) | np.arange(h.size, dtype=np.uint64)
        size = 1
        while size < 16:  # smallest of 2, 4, 8, 16 neighbours, then of SPREAD
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        low = np.minimum(low[:low.size - (SPREAD - 16)], low[SPREAD - 16:])
        window = np.arange(doc.size) - np.repeat(np.cumsum(n) - n, n) + starts[doc]
        anchor = (low[window] & _MASK24).astype(np.int64)
        fresh = np.flatnonzero(np.concatenate(
            ([True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]))))
        self.doc, self.at = doc[fresh], anchor[fresh]
        self.first, self.last = window[fresh], window[np.append(fresh[1:], window.size) - 1]
        self.key = h[self.at]
        self.on_left = self.first <= self.at - REACH
        self.on_right = self.last >= self.at - REACH
        with np.errstate(over="ignore"):
            before = h16[np.maximum(self.at - REACH, 0)]
            after = h16[np.minimum(self.at + GRAM + REACH - 16, h16.size - 1)]
            self.left = _mixed(self.key ^ (before * _power(3)))
            self.right = _mixed(self.key + after * _power(5))

    def sides(self) -> np.ndarray:
        return np.concatenate((self.left[self.on_left], self.right[self.on_right]))

    def suspected_sides(self, twice: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Side hashes that may be repeated, and the index of each one's anchor."""
        left = np.flatnonzero(self.on_left & contains(twice, self.left, 1))
        right = np.flatnonzero(self.on_right & contains(twice, self.right, 1))
        return (np.concatenate((self.left[left], self.right[right])),
                np.concatenate((left, right)))

    def repeated(self, sides: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Indexes of segments with a side in the filter, and their first and last window."""
        left = self.on_left & contains(sides, self.left)
        right = self.on_right & contains(sides, self.right)
        middle = self.at - REACH
        first = np.where(left, self.first, np.maximum(self.first, middle))
        last = np.where(right, self.last, np.minimum(self.last, middle))
        hit = np.flatnonzero(left | right)
        return hit, first[hit], last[hit]


def _pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, bytes, np.ndarray, np.ndarray,
                                                   np.ndarray]]:
    """(row of each piece, joined bytes, their starts, ends, offset in the text)."""
    row, part, offset, size = [], [], [], 0

    def joined():
        n = np.array([len(p) for p in part])
        ends = np.cumsum(n)
        return np.array(row), b"".join(part), ends - n, ends, np.array(offset)

    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - LENGTH + 1, 0), HASH_BYTES):
            piece = text[at:at + HASH_BYTES + LENGTH - 1]
            row.append(i)
            part.append(piece)
            offset.append(at)
            size += len(piece)
            if size >= HASH_BYTES:
                yield joined()
                row, part, offset, size = [], [], [], 0
    if part:
        yield joined()


def mix(ids: np.ndarray) -> np.ndarray:
    """Ids as hashes."""
    with np.errstate(over="ignore"):
        h = ids.astype(np.int64).view(np.uint64) * np.uint64(_BASE)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


def _texts(column: pa.Array, use: np.ndarray) -> list[bytes]:
    return [v.as_buffer().to_pybytes() if ok and v.is_valid else b""
            for v, ok in zip(column, use, strict=True)]


def _segments(batch: pa.RecordBatch, chosen: np.ndarray, sides: np.ndarray,
              split: np.ndarray | None):
    """Segments with a repeated side of a batch (d, text): row, key, segment, offset, windows."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    texts = _texts(batch.column(1), contains(chosen, mix(ids)))
    for row, body, starts, ends, offset in _pieces(texts):
        found = Anchors(np.frombuffer(body, np.uint8), starts, ends)
        hit, first, last = found.repeated(sides)
        doc, key = found.doc[hit], found.key[hit]
        fine = contains(split, key) if split is not None else np.zeros(key.size, bool)
        shift = offset[doc] - starts[doc]
        for i, k, a, b, s, by_window in zip(
                row[doc].tolist(), key.tolist(), first.tolist(), last.tolist(), shift.tolist(),
                fine.tolist(), strict=True):
            if by_window:
                for w in range(a, b + 1):
                    own = body[w:w + LENGTH]
                    yield i, k ^ xxhash.xxh3_64_intdigest(own), own, w + s, 1
            else:
                yield i, k, body[a:b + LENGTH], a + s, b - a + 1


def _signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def marks(groups: list[list[tuple[bytes, int]]]) -> list[list[int]]:
    """Per segment (text, smallest id) a mask of its windows that occur in a
    segment with a smaller id.  Each group's segments share an anchor."""
    flat = [s for g in groups for s in g]
    text = np.frombuffer(b"".join(s for s, _ in flat), np.uint8)
    size = np.array([len(s) for s, _ in flat])
    owner = np.array([d for _, d in flat])
    first = np.cumsum(size) - size
    segment = np.repeat(np.arange(size.size), size)
    offset = np.arange(text.size) - first[segment]
    words = words_at(text)
    order = suffix_array(text, words)
    order = order[offset[order] <= size[segment[order]] - LENGTH]  # whole windows
    shared = common_prefixes(order, words)
    run = np.flatnonzero(shared < LENGTH)  # starts of runs of equal windows
    least = np.minimum.reduceat(owner[segment[order]], run)
    least = np.repeat(least, np.diff(np.append(run, order.size)))
    gone = order[least < owner[segment[order]]]
    mask = np.zeros(size.size, np.int64)
    np.bitwise_or.at(mask, segment[gone], np.left_shift(1, offset[gone]))
    out, lo = [], 0
    for g in groups:
        out.append(mask[lo:lo + len(g)].tolist())
        lo += len(g)
    return out


def _sorted_groups(batches: Iterator[pa.RecordBatch]):
    """Per key: its segments with the smallest id and whether others have them.

    Rows come ordered by key, segment and id."""
    now, group = None, []
    for batch in batches:
        for key, segment, d in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != now:
                if group:
                    yield now, group
                now, group = key, []
            if group and group[-1][0] == segment:
                if d != group[-1][1]:
                    group[-1][2] = True
            else:
                group.append([segment, d, False])
    if group:
        yield now, group


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "segment", "first", "mask"]

    def done(rows):
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def rows_of(kept):
        found = marks([[(s, d) for s, d, _ in g] for _, g in kept])
        return [(key, _signed(xxhash.xxh3_64_intdigest(s)), d, m)
                for (key, g), masks in zip(kept, found, strict=True)
                for (s, d, more), m in zip(g, masks, strict=True) if more or m]

    kept, size, alone = [], 0, []
    for key, group in _sorted_groups(batches):
        if len(group) == 1:  # nothing to compare: the same windows wherever it occurs
            s, d, more = group[0]
            if more:
                alone.append((key, _signed(xxhash.xxh3_64_intdigest(s)), d, 0))
            if len(alone) >= 10_000:
                yield done(alone)
                alone = []
            continue
        kept.append((key, group))
        size += sum(len(s) for s, _, _ in group)
        if size >= SORT_BYTES:
            if rows := rows_of(kept):
                yield done(rows)
            kept, size = [], 0
    if kept and (rows := rows_of(kept)):
        alone += rows
    if alone:
        yield done(alone)


def _handed_on(least: dict[tuple[int, bytes], int],
               more: set[tuple[int, bytes]]) -> pa.RecordBatch:
    """Segments with their smallest id; a second row, with another id, tells that
    a second document has the segment."""
    keys = [*least, *more]
    ids = [*least.values(), *(least[at] + 1 for at in more)]
    return pa.RecordBatch.from_arrays(
        [pa.array([_signed(k) for k, _ in keys], pa.int64()),
         pa.array([s for _, s in keys], pa.binary()), pa.array(ids, pa.int64())],
        names=["key", "segment", "d"])


def dedup_substrings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`row` (the input row as a struct), kept (bytes), n_bytes, n_removed, n_spans."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    rows = docs.select(packed(docs).alias("row"), id_key(doc_id).alias("d"),
                       F.col(f"`{text}`").alias("text"))
    plain = rows.select("d", "text").where(F.octet_length("text") >= LENGTH)

    ids = materialise(plain.select(
        "d", F.xxhash64("text").alias("version"), F.md5("text").alias("digest")), "texts")
    firsts = materialise(ids.groupBy("digest").agg(F.min("d").alias("first"),
                                                   F.max("d").alias("last")), "first-texts")
    copies = (ids.join(firsts.where("first < last"), "digest").where("d > first")
              .select("d", "version").distinct())
    n = firsts.count()
    chosen = sc.broadcast(once_filter(firsts.select("first"), lambda b: mix(
        b.column(0).to_numpy(zero_copy_only=False)), filter_bits(n)))

    def found_in(batch: pa.RecordBatch) -> Iterator[Anchors]:
        own = batch.column(0).to_numpy(zero_copy_only=False)
        texts = _texts(batch.column(1), contains(chosen.value, mix(own)))
        for _, body, starts, ends, _ in _pieces(texts):
            yield Anchors(np.frombuffer(body, np.uint8), starts, ends)

    def sides(batch: pa.RecordBatch) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint64), *(a.sides() for a in found_in(batch))])

    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = filter_bits(4 * size // SPREAD, BITS_PER_SIDE)
    suspects = sc.broadcast(twice_filter(sides, plain, bits, probes=1))

    def suspected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            texts = _texts(batch.column(1), contains(chosen.value, mix(own)))
            side, key, d = [], [], []
            for row, body, starts, ends, _ in _pieces(texts):
                found = Anchors(np.frombuffer(body, np.uint8), starts, ends)
                hashes, at = found.suspected_sides(suspects.value)
                side.append(hashes)
                key.append(found.key[at])
                d.append(own[row[found.doc[at]]])
            if not side:
                continue
            side, key, d = (np.concatenate(x) for x in (side, key, d))
            by = np.argsort(side, kind="stable")
            side, key, d = side[by], key[by], d[by]
            first = np.flatnonzero(np.concatenate(
                (np.ones(min(1, side.size), bool), side[1:] != side[:-1])))
            if first.size:  # one row per side and batch
                yield pa.RecordBatch.from_arrays(
                    [pa.array(side[first].view(np.int64)), pa.array(key[first].view(np.int64)),
                     pa.array(np.minimum.reduceat(d, first)),
                     pa.array(np.maximum.reduceat(d, first)),
                     pa.array(np.diff(np.append(first, side.size)))],
                    names=["side", "key", "lo", "hi", "n"])

    confirmed = materialise(
        plain.mapInArrow(suspected, "side long, key long, lo long, hi long, n long")
        .groupBy("side", "key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                                    F.sum("n").alias("n"))
        .where("lo < hi").select("side", "key", "n"), "sides")
    repeated = sc.broadcast(once_filter(confirmed.select("side"), lambda b: b.column(0).to_numpy(
        zero_copy_only=False).view(np.uint64), filter_bits(confirmed.count())))
    large = confirmed.groupBy("key").agg(F.sum("n").alias("n")).where(
        F.col("n") > SPLIT_ABOVE).select("key")
    split = sc.broadcast(once_filter(large, lambda b: b.column(0).to_numpy(
        zero_copy_only=False).view(np.uint64), filter_bits(0)))

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_pylist()
            least: dict[tuple[int, bytes], int] = {}
            more: set[tuple[int, bytes]] = set()
            for i, key, segment, _, _ in _segments(batch, chosen.value, repeated.value,
                                                   split.value):
                d, at = own[i], (key, segment)
                known = least.get(at)
                if known is None:
                    least[at] = d
                elif d != known:
                    more.add(at)
                    least[at] = min(d, known)
                if len(least) >= MOST_SEGMENTS:
                    yield _handed_on(least, more)
                    least, more = {}, set()
            if least:
                yield _handed_on(least, more)

    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    compared = materialise(
        plain.mapInArrow(segments, "key long, segment binary, d long")
        .repartition(n_parts, "key").sortWithinPartitions("key", "segment", "d")
        .mapInArrow(_compare, "key long, segment long, first long, mask long"), "segments")

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        for batch in batches:
            own, versions = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            out = [(_signed(k), _signed(xxhash.xxh3_64_intdigest(s)), own[i], versions[i], at,
                    (1 << n) - 1)
                   for i, k, s, at, n in _segments(batch, chosen.value, repeated.value,
                                                   split.value)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                    names=["key", "segment", "d", "version", "at", "every"])

    found = plain.withColumn("version", F.xxhash64("text")).mapInArrow(
        occurrences, "key long, segment long, d long, version long, at long, every long")
    gone = (found.join(compared, ["key", "segment"])
            .withColumn("mask", F.when(F.col("d") > F.col("first"), F.col("every"))
                        .otherwise(F.col("mask"))).where("mask != 0")
            .select("d", "version", "at", "mask"))
    whole = copies.select("d", "version", F.lit(-1).cast("long").alias("at"),
                          F.lit(0).cast("long").alias("mask"))
    removals = gone.unionByName(whole).groupBy("d", "version").agg(
        F.collect_list("at").alias("at"), F.collect_list("mask").alias("mask"))

    @F.pandas_udf("kept binary, n_bytes long, n_removed long, n_spans long")
    def cut(body: pd.Series, at: pd.Series, mask: pd.Series) -> pd.DataFrame:
        out = [_cut(b"" if t is None else t.encode(), a, m)
               for t, a, m in zip(body, at, mask, strict=True)]
        return pd.DataFrame(out, columns=["kept", "n_bytes", "n_removed", "n_spans"])

    return (rows.withColumn("version", F.xxhash64("text"))
            .join(removals, ["d", "version"], "left")
            .select("row", cut("text", "at", "mask").alias("c")).select("row", "c.*"))


def _cut(text: bytes, at, mask) -> tuple[bytes, int, int, int]:
    n = len(text)
    if at is None or len(at) == 0:
        return text, n, 0, 0
    at, mask = np.asarray(at, np.int64), np.asarray(mask, np.int64)
    if (at < 0).any():
        return b"", n, n, 1
    bits = (mask[:, None] >> np.arange(SPREAD)) & 1
    segment, offset = np.nonzero(bits)
    edge = np.zeros(n + 1, np.int64)
    start = at[segment] + offset
    np.add.at(edge, start, 1)
    np.add.at(edge, start + LENGTH, -1)
    away = np.cumsum(edge[:-1]) > 0
    spans = int(away[0]) + int((away[1:] & ~away[:-1]).sum())
    return (np.frombuffer(text, np.uint8)[~away].tobytes(), n, int(away.sum()), spans)
