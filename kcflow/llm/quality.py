"""Quality rules: counted rules, then zstandard compression bands.

Each whole text is compressed, and so is each of its fixed chunks.  Text
that repeats itself compresses too well, noise too badly; what is usual
depends on the length, so `BANDS` has a lowest and highest ratio of
compressed to raw bytes per length band.  A document is kept when its own
ratio lies in its band and at most `BAD_CHUNKS` of its chunks fall outside
the band of theirs.

Words are runs of anything but ASCII white space.  Repeated 8-word windows
are found exactly: words get codes, codes of neighbours are paired three
times (2, 4, 8 words), each pairing renumbered without collisions.

Defined results: a null text has no words and no lines and fails the rules,
as an empty one does; repeated rows are judged each; an empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kcflow.llm.common import packed

LEVEL = 3
CHUNK_BYTES = 4096
WINDOW = 8
MIN_WORDS = 20
#: Highest share of words in repeated windows, in hundredths.
MAX_REPEATED = 30
SYMBOLS = b"#*$%&|<>"

#: (from so many bytes, lowest ratio, highest ratio); the last row that applies counts.
#: Set outside the range of the documents labelled good in the given tables, with a margin
#: that widens to the incompressible side, where few labels are.
BANDS = ((0, 0.30, 1.20), (128, 0.55, 0.95), (256, 0.48, 0.85), (512, 0.45, 0.78),
         (1024, 0.42, 0.68), (2048, 0.41, 0.64), (4096, 0.40, 0.60), (8192, 0.385, 0.58),
         (16384, 0.37, 0.56), (65536, 0.34, 0.55))
#: Highest share of chunks outside their band.
BAD_CHUNKS = 0.34

#: Bytes of text counted at once in a worker.
COUNT_BYTES = 4_000_000

RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean, ratio double, "
          "bad_chunks double")


def repeated_words(words: list[list[bytes]], window: int = WINDOW) -> np.ndarray:
    """Per text, the words inside windows that occur at least twice in it.

    `window` is a power of two.
    """
    n = np.array([len(w) for w in words], np.int64)
    total = np.zeros(len(words), np.int64)
    if n.sum() < window:
        return total
    flat = np.empty(n.sum(), dtype=object)
    flat[:] = [x for w in words for x in w]
    text = np.repeat(np.arange(len(words)), n)
    code, step = pd.factorize(flat)[0].astype(np.int64), 1
    while step < window:
        code = pd.factorize(code[:-step] * (code.max() + 1) + code[step:])[0].astype(np.int64)
        step *= 2
    inside = text[:code.size] == text[window - 1:]
    start = np.flatnonzero(inside)
    if not start.size:
        return total
    own = pd.factorize(text[start] * (code.max() + 1) + code[start])[0]
    again = start[np.bincount(own)[own] > 1]
    edge = np.zeros(flat.size + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + window, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(text[covered], minlength=len(words))


def band(size: int) -> tuple[float, float]:
    return next((lo, hi) for least, lo, hi in reversed(BANDS) if size >= least)


class Compressor:
    def __init__(self):
        self.zstd = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False,
                                             write_content_size=False)

    def ratio(self, data: bytes) -> float:
        return len(self.zstd.compress(data)) / len(data) if data else 0.0

    def judge(self, data: bytes) -> tuple[float, float, bool]:
        """The whole text's ratio, the share of bad chunks, and the verdict."""
        ratio = self.ratio(data)
        chunks = [data[i:i + CHUNK_BYTES] for i in range(0, len(data), CHUNK_BYTES)]
        bad = 0
        for chunk in chunks if len(chunks) > 1 else ():
            lo, hi = band(len(chunk))
            bad += not lo <= self.ratio(chunk) <= hi
        share = bad / len(chunks) if chunks else 0.0
        lo, hi = band(len(data))
        return ratio, share, lo <= ratio <= hi and share <= BAD_CHUNKS


def counts(texts: list[bytes | None]) -> pd.DataFrame:
    """All columns of RESULT for some texts."""
    zstd = Compressor()
    words = [(t or b"").split() for t in texts]
    repeats = repeated_words(words)
    rows = []
    for t, w, repeat in zip(texts, words, repeats.tolist(), strict=True):
        t = t or b""
        lines = [x for x in t.split(b"\n") if x.strip()]
        failed = len(w) < MIN_WORDS or 100 * repeat > MAX_REPEATED * len(w)
        ratio, share, good = zstd.judge(t)
        joined = b"".join(w)
        rows.append((len(w), len(joined) if joined.isascii() else len(joined.decode()),
                     len(t) - len(t.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
                     repeat, failed, good and not failed, ratio, share))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])


def judge_quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """`row` (the input row as a struct) and the columns of RESULT."""

    @F.pandas_udf(RESULT)
    def judged(body: pd.Series) -> pd.DataFrame:
        texts = [None if t is None else t.encode() for t in body]
        out, lo = [], 0
        while lo < len(texts):
            size, hi = 0, lo
            while hi < len(texts) and (size < COUNT_BYTES or hi == lo):
                size += len(texts[hi] or b"")
                hi += 1
            out.append(counts(texts[lo:hi]))
            lo = hi
        return pd.concat(out, ignore_index=True) if out else counts([])

    return docs.select(packed(docs).alias("row"), judged(F.col(f"`{text}`")).alias("q")).select(
        "row", "q.*")
