"""Line dedup across documents with two Bloom filters.

A line's key is the line without leading and trailing ASCII white space,
A-Z lower-cased.  A key of at least `min_chars` code points that is found
in two or more documents keeps its lines in the document with the smallest
id only; there all of them stay, and shorter lines always stay.

1. One pass marks every document's key hashes in the once and twice filters.
2. A second pass keeps the lines whose hash is in the twice filter.  Only
   these suspects shuffle, with their text.
3. Per key text, min and max of the ids (combined before the shuffle)
   confirm or clear it exactly and give its first document.
4. The positions to drop are gathered per document and its lines rebuilt, by
   Spark's own functions.

Python gets a bounded number of whole texts at once.

A key in a third of all documents is one row after map-side combining; the
join back to its suspects is an inner join that adaptive execution splits.

Defined results: a null or empty text is one empty line; a null doc_id is
one document after all others; rows that repeat a doc_id count as the same
document and each is cleaned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kcflow.llm.bloom import contains, count_lines, filter_bits, twice_filter
from kcflow.llm.common import arrow_batches, id_key, materialise, packed

MIN_CHARS = 10


def line_keys(text: bytes) -> list[bytes]:
    """The key of every line; bytes.strip and bytes.lower know ASCII only."""
    return [line.strip() for line in text.lower().split(b"\n")]


def long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (key.isascii() or len(key.decode("utf-8", "replace")) >= least)


def _hash(key: bytes) -> int:
    return xxhash.xxh3_64_intdigest(key)


def _texts(column: pa.Array) -> Iterator[bytes]:
    for value in column:
        yield value.as_buffer().to_pybytes() if value.is_valid else b""


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per input row: `row` (all input columns as a struct), `text`
    (lines that stay; null stays null), `n_lines` and `n_dropped`."""
    spark = docs.sparkSession
    rows = docs.select(packed(docs).alias("row"), id_key(doc_id).alias("d"),
                       F.col(f"`{text}`").alias("text"))
    keyed = rows.select("d", F.xxhash64("text").alias("version"), "text")

    def hashes(batch: pa.RecordBatch) -> np.ndarray:
        out: list[int] = []
        for body in _texts(batch.column(0)):
            out += {_hash(k) for k in line_keys(body) if long_enough(k, min_chars)}
        return np.array(out, np.uint64)

    bits = filter_bits(count_lines(rows, "text"))
    with arrow_batches(spark):
        twice = spark.sparkContext.broadcast(twice_filter(hashes, rows.select("text"), bits))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            doc, at, keys, found = [], [], [], []
            for i, body in enumerate(_texts(batch.column(2))):
                for p, key in enumerate(line_keys(body)):
                    if long_enough(key, min_chars):
                        doc.append(i)
                        at.append(p)
                        keys.append(key)
                        found.append(_hash(key))
            if not keys:
                continue
            hit = np.flatnonzero(contains(twice.value, np.array(found, np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[doc[j]] for j in hit], pa.int64()),
                 pa.array([versions[doc[j]] for j in hit], pa.int64()),
                 pa.array([at[j] for j in hit], pa.int32()),
                 pa.array([keys[j] for j in hit], pa.binary())],
                names=["d", "version", "at", "key"])

    with arrow_batches(spark):
        suspected = materialise(
            keyed.mapInArrow(suspects, "d long, version long, at int, key binary"), "line-suspects")
    twice.destroy()  # the suspects are written
    # written, so that the join below has an exchange on both sides and can be split
    first = materialise(
        suspected.groupBy("key").agg(F.min("d").alias("first"), F.max("d").alias("last"))
        .where("first < last").select("key", "first"), "first-lines")
    drops = (suspected.join(first, "key").where(F.col("d") > F.col("first"))
             .groupBy("d", "version").agg(F.collect_list("at").alias("drops")))

    # whole texts stay in Spark here: only positions are looked up
    lines = rows.select("row", "d", "text", F.xxhash64("text").alias("version"), F.split(
        F.coalesce("text", F.lit("")), "\n", -1).alias("lines")).join(drops, ["d", "version"], "left")
    kept = lines.select("row", "text", "lines", "drops", F.array_except(
        F.sequence(F.lit(0), F.size("lines") - 1), "drops").alias("kept"))
    whole = F.col("drops").isNull()
    return kept.select(
        "row",
        F.when(whole, F.col("text")).otherwise(F.array_join(F.transform(
            "kept", lambda at: F.get("lines", at)), "\n")).alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(whole, F.lit(0)).otherwise(F.size("lines") - F.size("kept"))
        .cast("long").alias("n_dropped"))
