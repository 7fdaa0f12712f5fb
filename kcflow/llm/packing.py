"""Best-fit packing of tokenised documents into sequences of one capacity.

Documents are tokenised once, longer ones cut into pieces of the capacity
(the first piece may be shorter).  The plan needs the piece lengths only,
so it is made from their histogram, which has at most `capacity` entries
whatever the corpus:

- lengths above one third of the capacity go at most two to a sequence:
  from the longest down, each is matched with the longest that still fits;
- smaller ones, longest first, go to the smallest gap that takes them, and
  open new sequences when no gap does.

The plan is a list of sequence layouts with the number of sequences of
each.  A piece finds its place by its rank among the pieces of its length
(numbered without gathering a length in one task), so no task holds more
than a block of pieces and the plan covers every piece exactly once.  Token
ids are not numbered with their pieces: a block of full pieces would sort all
of theirs at once.  They meet the places at the end, dealt evenly by piece.

Defined results: a null or empty text is the end id alone; a null doc_id is
one document after all others; repeated rows are packed each; an empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kcflow.llm.common import arrow_batches, id_back, id_key, materialise
from kcflow.llm.numbering import gapless
from kcflow.llm.tokens import Encoder

CAPACITY = 1024
END_ID = 2

#: Pieces that a worker hands on at once.
MOST_ROWS = 4096

PIECES = "d long, piece int, start long, length long, ids_crc32 long"


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Layouts (piece lengths in order) and how many sequences have each."""
    left = {s: c for s, c in counts.items() if c > 0}
    large = sorted((s for s in left if 3 * s > capacity), reverse=True)
    gaps: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    done: list[tuple[tuple[int, ...], int]] = []

    def put(layout: tuple[int, ...], n: int) -> None:
        gap = capacity - sum(layout)
        (gaps[gap] if gap else done).append((layout, n))

    for s in large:
        for partner in large:  # longest first
            if not left[s]:
                break
            if partner > s or s + partner > capacity or not left[partner]:
                continue
            n = left[s] // 2 if partner == s else min(left[s], left[partner])
            if n:
                left[s] -= n
                left[partner] -= n
                put((s, partner), n)
        if left[s]:
            put((s,), left[s])
            left[s] = 0
    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[s]:
            fitting = [g for g, open_ in gaps.items() if g >= s and open_]
            if not fitting:  # new sequences, filled with this length
                each = min(capacity // s, left[s])
                n = left[s] // each
                left[s] -= n * each
                put((s,) * each, n)
                continue
            gap = min(fitting)
            layout, n = gaps[gap].pop()
            each = min(gap // s, left[s])
            used = min(n, left[s] // each)
            left[s] -= used * each
            if n > used:
                gaps[gap].append((layout, n - used))
            put(layout + (s,) * each, used)
    return done + [x for open_ in gaps.values() for x in open_]


def places(layouts: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per length: rows (first rank, first sequence, offset), by first rank."""
    ranks: dict[int, int] = defaultdict(int)
    out: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for layout, n in layouts:
        offset = 0
        for s in layout:
            out[s].append((ranks[s], sequence, offset))
            ranks[s] += n
            offset += s
        sequence += n
    return {s: np.array(rows, np.int64) for s, rows in out.items()}


def tokenised_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY,
                     doc_id: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """d (id key), piece, start, length, ids_crc32 and, if asked for, the ids."""

    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
    names = ["d", "piece", "start", "length", "ids_crc32", "ids"]

    def handed_on(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=False)],
            names=names[:len(columns)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.at(tokenizer)
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.append(encoder.encode(text.as_py() or ""),
                                np.uint32(END_ID)).astype("<u4")
                begin, k = 0, 0
                while begin < own.size:
                    short = (own.size - begin) % capacity
                    piece = own[begin:begin + (short or capacity)]
                    rows.append((key, k, begin, piece.size, zlib.crc32(piece.tobytes()),
                                 *([piece] if ids else [])))
                    begin, k = begin + piece.size, k + 1
                if len(rows) >= MOST_ROWS:
                    yield handed_on(rows)
                    rows = []
            if rows:
                yield handed_on(rows)

    return docs.select(id_key(doc_id).alias("d"), F.col(f"`{text}`").alias("text")).mapInArrow(
        cut, PIECES + (", ids array<int>" if ids else ""))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, doc_id: str = "doc_id",
         text: str = "text", ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset and, if asked for, the ids."""
    spark = docs.sparkSession
    tokenised = tokenised_pieces(docs, tokenizer, capacity, doc_id, text, ids)
    if ids:  # names a piece in the written table, where whole pieces may be equal
        tokenised = tokenised.withColumn("at", F.monotonically_increasing_id())
    with arrow_batches(spark):
        pieces = materialise(tokenised, "pieces")
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(
        F.count(F.lit(1)).alias("n")).collect()}  # `capacity` rows at most
    table = spark.sparkContext.broadcast(places(plan(histogram, capacity)))
    ranked = gapless(pieces.drop("ids"), ["length"], ["d", "piece", "start", "ids_crc32"], "rank",
                     rows=sum(histogram.values()))

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(length), 2), np.int64)
        lengths, ranks = length.to_numpy(), rank.to_numpy()
        for s in np.unique(lengths):
            rows, of = table.value[int(s)], lengths == s
            at = np.searchsorted(rows[:, 0], ranks[of], side="right") - 1
            out[of, 0] = rows[at, 1] + ranks[of] - rows[at, 0]
            out[of, 1] = rows[at, 2]
        return pd.DataFrame(out, columns=["sequence_id", "offset"])

    found = ranked.withColumn("p", placed("length", "rank"))
    if ids:
        found = found.join(pieces.select("at", "ids"), "at")
    return found.select(
        id_back("d").alias(doc_id), "piece", "start", "length", "ids_crc32",
        "p.sequence_id", "p.offset", *(["ids"] if ids else []))
