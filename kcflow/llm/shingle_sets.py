"""Sets of hashed word shingles of many texts at once, in numpy.

Words are runs of anything but ASCII white space, A-Z lower-cased.  The set
of a text holds the 64-bit hashes of its five-word shingles; a text of one
to four words is one shingle; a text without words has none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5
#: Bytes of text taken at once; longer texts are hashed in blocks of this size.
TAKE_BYTES = 1_000_000

_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_powers: list[np.ndarray] = []


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 of the (odd) base modulo 2^64, and of its inverse."""
    if not _powers or _powers[0].size < n:
        size = max(n, TAKE_BYTES)
        _powers[:] = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers.append(np.cumprod(table))
    return _powers[0][:n], _powers[1][:n]


def word_hashes(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, and where it starts.

    The bytes of a word are the digits of a number in the base; all of them
    come from one running sum.
    """
    data, hashes, places, lo = np.frombuffer(body, np.uint8), [], [], 0
    with np.errstate(over="ignore"):
        while lo < data.size:
            hi = lo + TAKE_BYTES
            if hi < data.size:  # never inside a word
                space = _SPACE.search(body, hi)
                hi = space.start() if space else data.size
            block = data[lo:hi]
            up, down = _power_tables(block.size)
            total = np.zeros(block.size + 1, np.uint64)
            np.cumsum((block.astype(np.uint64) + np.uint64(1)) * up, out=total[1:])
            blank = np.concatenate(([True], _IS_SPACE[block], [True]))
            edge = np.flatnonzero(blank[1:] != blank[:-1])
            start, end = edge[::2], edge[1::2]
            h = (total[end] - total[start]) * down[start] if start.size else total[:0]
            hashes.append(_mixed(h + (end - start).astype(np.uint64)))
            places.append(start + lo)
            lo = hi
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(places)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct hashes of each text."""
    word, at = word_hashes(b"\n".join(texts).lower())
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    first = np.searchsorted(at, begin)
    out = []
    with np.errstate(over="ignore"):
        h = word.copy()[:max(word.size - SHINGLE + 1, 0)]
        for k in range(1, SHINGLE):
            h = h * _STEP + word[k:k + h.size]
        h = _mixed(h)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= SHINGLE:
                out.append(np.unique(h[a:b - SHINGLE + 1]))
            elif b > a:
                few = np.uint64(b - a)  # tells short texts from shingles
                for w in word[a:b]:
                    few = few * _STEP + w
                out.append(_mixed(np.array([few])))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def by_part(column: pa.Array, use: np.ndarray | None = None) -> Iterator[tuple[int, list]]:
    """(row of the first, sets) for parts of a text column; texts not in `use` are empty."""
    lo, n = 0, len(column)
    while lo < n:
        part, size, hi = [], 0, lo
        while hi < n and (size < TAKE_BYTES or hi == lo):
            value = column[hi]
            wanted = value.is_valid and (use is None or use[hi])
            part.append(value.as_buffer().to_pybytes() if wanted else b"")
            size += len(part[-1])
            hi += 1
        yield lo, shingle_sets(part)
        lo = hi
