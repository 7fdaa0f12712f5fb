"""Two-stage suffix sorting of one task's text, with numpy.

A suffix is small when it is smaller than its successor (the suffix that
starts one byte later), else large.  Only the small ones are compared with
each other; each large one then falls into place by scanning the buckets of
first bytes in order: whatever precedes an already placed suffix goes next
in the bucket of its own first byte.

Suffixes are told apart by their first DEPTH bytes at least; the order of
suffixes that agree further is arbitrary.  That is all that common prefixes
of up to DEPTH bytes need.
"""

from __future__ import annotations

import numpy as np

DEPTH = 56
_WORD = 8


def words_at(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as a big-endian number (zeros after the end)."""
    padded = np.concatenate((text, np.zeros(DEPTH + _WORD, np.uint8)))
    out, width = padded.astype(np.uint64), 1
    while width < _WORD:
        shifted = np.concatenate((out[width:], np.zeros(width, np.uint64)))
        out = (out << np.uint64(8 * width)) | shifted
        width *= 2
    return out


def small_suffixes(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor; the last one is not."""
    n = text.size
    ends = np.append(np.flatnonzero(text[:-1] != text[1:]), n - 1)  # of runs of a byte
    following = np.append(text[1:], 0)[ends]
    rising = text[ends] < following
    rising[-1] = False
    return np.repeat(rising, np.diff(ends, prepend=-1))


def sort_directly(at: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, by DEPTH bytes."""
    order = at[np.argsort(words[at])]
    first = words[order]
    tied = np.concatenate((first[1:] == first[:-1], [False]))
    block = np.cumsum(np.concatenate(([True], first[1:] != first[:-1])))
    open_ = np.flatnonzero(tied | np.concatenate(([False], tied[:-1])))
    for depth in range(_WORD, DEPTH, _WORD):
        if not open_.size:
            break
        pos, key = order[open_], block[open_]
        word = words[pos + depth]
        by = np.lexsort((word, key))
        pos, word = pos[by], word[by]  # key is sorted already and stays
        order[open_] = pos
        same = (key[1:] == key[:-1]) & (word[1:] == word[:-1])
        block_of = np.cumsum(np.concatenate(([True], ~same)))
        tied = np.concatenate((same, [False]))
        still = tied | np.concatenate(([False], same))
        open_, block = open_[still], block.copy()
        block[open_] = block_of[still]
    return order


def suffix_array(text: np.ndarray, words: np.ndarray) -> np.ndarray:
    """All positions in the order of their suffixes (by DEPTH bytes at least)."""
    n = text.size
    if n == 0:
        return np.zeros(0, np.int64)
    small = small_suffixes(text)
    direct = sort_directly(np.flatnonzero(small), words)
    starts = np.searchsorted(text[direct], np.arange(257)) if direct.size else np.zeros(257, int)
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[int(text[n - 1])].append(np.array([n - 1]))  # before all others of its byte
    out = []

    def induce(placed: np.ndarray, own: int) -> np.ndarray:
        """Hand the large predecessors on; those of the same byte are returned."""
        before = placed[placed > 0] - 1
        before = before[~small[before]]
        byte = text[before]
        again = before[byte == own]
        other, byte = before[byte > own], byte[byte > own]
        if other.size:
            by = np.argsort(byte, kind="stable")
            other, byte = other[by], byte[by]
            cut = np.flatnonzero(byte[1:] != byte[:-1]) + 1
            for part, b in zip(np.split(other, cut), byte[np.concatenate(([0], cut))],
                               strict=True):
                waiting[b].append(part)
        return again

    for b in range(256):
        wave = np.concatenate(waiting[b]) if waiting[b] else np.zeros(0, np.int64)
        while wave.size:  # runs of one byte come one step at a time
            out.append(wave)
            wave = induce(wave, b)
        own = direct[starts[b]:starts[b + 1]]
        if own.size:
            out.append(own)
            induce(own, b)
        waiting[b] = []
    return np.concatenate(out)


def common_prefixes(order: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Bytes that each position of `order` shares with the one before it, up to DEPTH."""
    shared = np.zeros(order.size, np.int64)
    going = np.arange(1, order.size)
    for depth in range(0, DEPTH, _WORD):
        if not going.size:
            break
        differ = words[order[going] + depth] ^ words[order[going - 1] + depth]
        # equal leading bytes of the word, from the place of the highest bit that differs
        high = np.zeros(going.size, np.int64)
        rest = differ.copy()
        for shift in (32, 16, 8):
            big = rest >> np.uint64(shift) > 0
            high[big] += shift
            rest[big] >>= np.uint64(shift)
        shared[going] += np.where(differ == 0, _WORD, 7 - high // 8)
        going = going[differ == 0]
    return shared
