"""Two Bloom filters: hashes seen once, and hashes seen at least twice.

Every batch of rows hands on the positions of the bits that its hashes set,
so what is moved follows the number of distinct hashes, not the size of the
filter.  The merge runs per segment of the bit range: a bit is set in the
twice filter when a batch set it there, or when two batches set it in the
once filter.  Nothing seen twice can be missed; a hash seen once may
be suspected.

The twice filter has at most MAX_BITS bits (128 MiB), whatever the input:
that is the proven bound of what is broadcast.  Above about 8 x 10^7 keys
the filter fills up and more keys are suspected; callers confirm suspects
exactly, so results do not change.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
MIN_BITS, MAX_BITS = 2**20, 2**30
SEGMENTS = 64


def filter_bits(keys: int, bits_per_key: int = BITS_PER_KEY) -> int:
    """Bits for so many keys: a power of two within the bounds."""
    wanted = max(1, keys) * bits_per_key
    return min(MAX_BITS, max(MIN_BITS, 1 << (wanted - 1).bit_length()))


def positions(hashes: np.ndarray, bits: int, probes: int = 2) -> list[np.ndarray]:
    """The bit positions of each 64-bit hash, one array per probe (one or two)."""
    h = hashes.view(np.uint64) if hashes.dtype != np.uint64 else hashes
    mask = np.uint64(bits - 1)
    return [((h >> np.uint64(shift)) & mask).astype(np.int64) for shift in (0, 32)[:probes]]


def mark(bitmap: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(bitmap, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))


def test(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def contains(bitmap: np.ndarray, hashes: np.ndarray, probes: int = 2) -> np.ndarray:
    """Which hashes may be in the filter."""
    found = [test(bitmap, at) for at in positions(hashes, bitmap.size * 8, probes)]
    return found[0] & found[-1]


def marked(hashes: np.ndarray, bits: int, probes: int = 2) -> Iterator[pa.RecordBatch]:
    """The bits that a batch of hashes sets, by segment: those of all its hashes, and
    those of hashes that it holds twice."""
    ordered = np.sort(hashes)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    once = np.sort(np.concatenate(positions(ordered, bits, probes)).astype(np.uint32)).astype(np.int64)
    twice = np.sort(np.concatenate(positions(again, bits, probes)))
    size = bits // SEGMENTS
    edges = np.arange(SEGMENTS + 1) * size
    once_at, twice_at = np.searchsorted(once, edges), np.searchsorted(twice, edges)
    used = np.flatnonzero(np.diff(once_at))

    def steps(at: np.ndarray, bounds: np.ndarray, s: int) -> bytes:
        """Positions inside the segment, as 32-bit steps from one to the next."""
        own = at[bounds[s]:bounds[s + 1]] - edges[s]
        return np.diff(own, prepend=0).astype(np.uint32).tobytes()

    if used.size:
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()),
             pa.array([steps(once, once_at, s) for s in used], pa.binary()),
             pa.array([steps(twice, twice_at, s) for s in used], pa.binary())],
            names=["seg", "once", "twice"])


def twice_filter(batches_to_hashes, source: DataFrame, bits: int, probes: int = 2) -> np.ndarray:
    """The merged twice filter of all rows of `source`.

    `batches_to_hashes` turns an Arrow batch into an array of 64-bit hashes
    in which each document should give each of its hashes once (if it does
    not, its own repeats are suspected too).
    """
    return _filter(source, batches_to_hashes, bits, "twice", probes)


def once_filter(source: DataFrame, batches_to_hashes, bits: int) -> np.ndarray:
    """The filter of all hashes of `source`, seen once or more."""
    return _filter(source, batches_to_hashes, bits, "once", 2)


def _filter(source: DataFrame, batches_to_hashes, bits: int, wanted: str,
            probes: int) -> np.ndarray:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from marked(batches_to_hashes(batch), bits, probes)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, now, once, twice = bits // 8 // SEGMENTS, None, None, None

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int32()),
                 pa.array([(twice if wanted == "twice" else once).tobytes()], pa.binary())],
                names=["seg", "bits"])

        for batch in batches:
            for seg, o, t in zip(*(batch.column(i) for i in range(3)), strict=True):
                if seg.as_py() != now:
                    if now is not None:
                        yield done()
                    now = seg.as_py()
                    once, twice = np.zeros(size, np.uint8), np.zeros(size, np.uint8)
                at = np.cumsum(np.frombuffer(o.as_buffer(), np.uint32), dtype=np.int64)
                mark(twice, at[test(once, at)])
                mark(once, at)
                mark(twice, np.cumsum(np.frombuffer(t.as_buffer(), np.uint32), dtype=np.int64))
        if now is not None:
            yield done()

    parts = source.mapInArrow(build, "seg int, once binary, twice binary")
    merged = (parts.repartition(SEGMENTS, "seg").sortWithinPartitions("seg")
              .mapInArrow(merge, "seg int, bits binary"))
    bitmap = np.zeros(bits // 8, np.uint8)
    size = bits // 8 // SEGMENTS
    rows = merged.collect()  # SEGMENTS rows, MAX_BITS / 8 bytes at most
    while rows:
        row = rows.pop()
        bitmap[row.seg * size:(row.seg + 1) * size] = np.frombuffer(row.bits, np.uint8)
    return bitmap


def count_lines(docs: DataFrame, text: str) -> int:
    """Lines of all texts, to size the filters."""
    breaks = F.octet_length(text) - F.octet_length(F.replace(F.col(text), F.lit("\n"), F.lit("")))
    return docs.agg(F.sum(F.coalesce(breaks, F.lit(0)) + 1)).first()[0] or 0
