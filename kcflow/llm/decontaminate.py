"""Benchmark decontamination with SimHash over item-sized windows.

Texts are lower-cased words between ASCII white space; a shingle is five
words in a row (an item of fewer words is one shingle).  Similarity of a
window and an item is the weighted Jaccard similarity of their shingles,
weighted by how often each occurs: sum of minima over sum of maxima.

1. A join on shingle hashes finds the places of an item's shingles in a
   document.  Running sums over them give the sum of minima for every window
   of the item's size, wherever it starts and in whatever order it holds the
   shingles; the best window of each document and item goes on if it can
   reach the similarity.
2. Every such window and every item gets a 64-bit SimHash: bit b is set when
   more than half of its shingles (with weights) have bit b in their hash.
3. The 64 bits are cut into RADIUS + 1 blocks.  Two fingerprints within the
   radius differ in RADIUS bits at most, so they agree in a whole block:
   an equality join on (item, block, its bits) misses none of them.
4. What is within the radius is verified exactly.

At the lowest similarity that counts, 0.75, two fingerprints differ in 11
bits on average with a deviation of 3, so the radius of 24 leaves out about
one such pair in 10^5 and practically none above.  The path is DataFrame
functions only; the item shingles are broadcast up to MAX_BROADCAST rows,
else the join shuffles.

Defined results: null and empty texts and items match nothing; a window at
the end of a document is moved back to fit, a document shorter than the
item is one window; a null doc_id is one document after all others; a null
item_id is one more item; rows that repeat a doc_id with another text are
judged each, and the best window of the id is reported; among equally
similar windows one goes first that has a shared shingle at its place in the
item, then the smallest start; empty tables give an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kcflow.llm.common import ASCII_SPACE, id_back, id_key, materialise

SHINGLE = 5
SIMILARITY = 0.75
RADIUS = 24
#: Item shingles that are broadcast at most (24 bytes each).
MAX_BROADCAST = 1_000_000

_LANES = 0x0000000100000001  # bits b and b + 32, with room for 2^31 shingles


def words(text: Column) -> Column:
    """Lower-cased words of a text; null without any."""
    bare = F.btrim(F.lower(text), F.lit(ASCII_SPACE))
    return F.when(bare != "", F.split(bare, r"[\x20\x09-\x0D]+"))


def shingles(word: Column, k: int) -> Column:
    """Hashes of the k-word shingles in order; empty when there are fewer words."""
    return F.when(F.size(word) >= k, F.transform(
        F.sequence(F.lit(1), F.size(word) - k + 1),
        lambda i: F.xxhash64(F.slice(word, i, k)))).otherwise(
            F.array().cast("array<bigint>"))


def fingerprints(exploded: DataFrame, key: list[str]) -> DataFrame:
    """`key`, n and the 64-bit SimHash of rows (key, h)."""
    lanes = exploded.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(F.shiftrightunsigned("h", b).bitwiseAND(_LANES)).alias(f"s{b}") for b in range(32)])
    bits = [F.when(2 * F.shiftright(f"s{b}", 32 * j).bitwiseAND(0xFFFFFFFF) > F.col("n"),
                   F.shiftleft(F.lit(1).cast("long"), b + 32 * j)).otherwise(F.lit(0).cast("long"))
            for b in range(32) for j in range(2)]
    return lanes.select(*key, "n", reduce(lambda x, y: x.bitwiseOR(y), bits).alias("mark"))


def blocks(mark: str, radius: int) -> Column:
    """(block number, its bits) of RADIUS + 1 blocks."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    return F.array(*[F.struct(
        F.lit(i).alias("block"),
        (F.shiftrightunsigned(mark, lo).bitwiseAND((1 << (hi - lo)) - 1) if hi - lo < 63
         else F.col(mark)).alias("bits"))
        for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True))])


def best_starts(found: DataFrame, weights: DataFrame, similarity: float) -> DataFrame:
    """Per document text and item the start of the most similar of all windows, if it
    reaches the similarity: rows (d, version, item, copy, size, k, start).

    `found` has the places (pos) of the item's shingles in the document.  The j-th place
    of a shingle that the item has w times adds to the sum of minima of the windows that
    hold it but not the place w before it.  These are a range of starts, so running sums
    over the ends of the ranges give that sum for every start.
    """
    key = ["d", "version", "item", "copy", "n", "size", "k"]
    in_window = F.least("n", "size") - F.col("k") + 1  # shingles of a window
    both = in_window + F.col("size") - F.col("k") + 1
    # too few places in all: no window of them can reach the similarity
    enough = found.groupBy(*key).agg(F.collect_set(F.struct("pos", "h")).alias("at")).where(
        F.size("at") >= similarity * (both - F.size("at")))
    same = (F.col("f.item").eqNullSafe(F.col("w.item")) & (F.col("f.copy") == F.col("w.copy"))
            & (F.col("f.h") == F.col("w.h")))
    placed = (enough.select(*key, F.inline("at")).groupBy(*key, "h")
              .agg(F.array_sort(F.collect_list("pos")).alias("at")).alias("f")
              .join(weights.alias("w"), same)
              .select(*[f"f.{c}" for c in key], "at", "item_weight", "places")
              .withColumn("last", F.greatest(F.lit(0), F.col("n") - F.col("size"))))
    before = F.when(F.col("i") >= F.col("item_weight"),
                    F.get("at", F.col("i") - F.col("item_weight")))
    ranges = (placed.select("*", F.posexplode("at").alias("i", "pos"))
              .withColumn("low", F.greatest(F.lit(0), before + 1, F.col("pos") - in_window + 1))
              .withColumn("high", F.least("pos", "last")))
    zero, one = F.lit(0), F.lit(1)
    # the starts at which a shared shingle has its place in the item: first among equals
    level = F.transform("places", lambda at: F.struct(
        F.greatest(zero, F.least(F.col("pos") - at, F.col("last"))).alias("start"),
        zero.alias("step"), one.alias("level")))
    step = F.when(F.col("low") <= F.col("high"), F.array(
        F.struct(F.col("low").alias("start"), one.alias("step"), zero.alias("level")),
        F.struct((F.col("high") + 1).alias("start"), (-one).alias("step"), zero.alias("level")))) \
        .otherwise(F.array())
    steps = ranges.select(*key, "last", F.inline(F.concat(step, level))).groupBy(
        *key, "last", "start").agg(F.sum("step").alias("step"), F.max("level").alias("level"))
    least = F.sum("step").over(Window.partitionBy(*key).orderBy("start").rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    scored = steps.withColumn("least", least).where(
        (F.col("start") <= F.col("last"))
        & (F.col("least") / (both - F.col("least")) >= similarity))
    return scored.groupBy(*key).agg(F.max(F.struct(
        "least", "level", (-F.col("start")).alias("back"))).alias("best")).select(
            "d", "version", "item", "copy", "size", "k", (-F.col("best.back")).alias("start"))


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id",
                 text: str = "text", item_id: str = "item_id", item_text: str = "text",
                 similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """Documents with a window similar to an item.

    One row per document and item: doc_id, item_id, start (word of the best
    window, from 0), n_words (of the window), distance (bits) and similarity.
    """
    best = _best(contaminated_texts(docs, benchmark, doc_id, text, item_id, item_text,
                                    similarity, radius), ["d", "item"])
    return best.select(id_back("d").alias(doc_id), F.col("item").alias(item_id),
                       "start", "n_words", "distance", "similarity")


def _best(windows: DataFrame, key: list[str]) -> DataFrame:
    """The most similar window of each key, the first one of equals."""
    return windows.groupBy(*key).agg(F.max(F.struct(
        "similarity", (-F.col("start")).alias("back"), "n_words",
        (-F.col("distance")).alias("near"))).alias("b")).select(
            *key, (-F.col("b.back")).alias("start"), "b.n_words",
            (-F.col("b.near")).alias("distance"), "b.similarity")


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id",
                       text: str = "text", item_id: str = "item_id", item_text: str = "text",
                       similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """As `contaminated`, one row per text of a document and item: d (the id as a long,
    null as the last), version (a hash of the text), item, start, n_words, distance and
    similarity."""
    items = materialise(
        benchmark.select(F.col(f"`{item_id}`").alias("item"),
                         words(F.col(f"`{item_text}`")).alias("w"))
        .where("w IS NOT NULL").dropDuplicates(["item", "w"])
        .select("item", F.xxhash64("w").alias("copy"), F.size("w").alias("size"),
                F.least(F.size("w"), F.lit(SHINGLE)).alias("k"), "w"), "items")
    kinds = sorted(r.k for r in items.select("k").distinct().collect())  # 1 to SHINGLE
    spark = docs.sparkSession
    if not kinds:
        return spark.createDataFrame([], "d long, version long, item long, start int, "
                                         "n_words int, distance int, similarity double")
    parts = reduce(DataFrame.unionByName, [
        items.where(F.col("k") == k).select(
            "item", "copy", "size", "k", F.posexplode(shingles(F.col("w"), k)).alias("at", "h"))
        for k in kinds])
    item_shingles = materialise(parts, "item-shingles")
    weights = materialise(item_shingles.groupBy("item", "copy", "size", "k", "h").agg(
        F.count(F.lit(1)).cast("int").alias("item_weight"),
        F.collect_list("at").alias("places")), "item-weights")
    probe, known = weights.select("item", "copy", "size", "k", "h"), weights
    if item_shingles.count() <= MAX_BROADCAST:
        probe, known = F.broadcast(probe), F.broadcast(known)

    texts = docs.select(id_key(doc_id).alias("d"), F.xxhash64(f"`{text}`").alias("version"),
                        F.col(f"`{text}`").alias("t"))
    split = texts.select("d", "version", words(F.col("t")).alias("w"))
    found = reduce(DataFrame.unionByName, [
        split.select("d", "version", F.size("w").alias("n"),
                     F.posexplode(shingles(F.col("w"), k)).alias("pos", "h"))
        .withColumn("k", F.lit(k)) for k in kinds]).join(probe, ["h", "k"])
    hits = materialise(best_starts(found, known, similarity), "hits")

    key = ["d", "version", "item", "copy", "start"]
    w = F.slice(words(F.col("t")), F.col("start") + 1, F.col("size"))
    # the window's words are as few as the item's, so this stays small per row
    windows = hits.join(texts, ["d", "version"]).select(*key, "size", "k", w.alias("w")) \
        .dropDuplicates(key)
    exploded = materialise(reduce(DataFrame.unionByName, [
        windows.where(F.col("k") == k).select(
            *key, F.size("w").alias("size"), F.explode(shingles(F.col("w"), k)).alias("h"))
        for k in kinds]).groupBy(*key, "size", "h").agg(F.count(F.lit(1)).alias("weight")),
        "windows")

    of_windows = fingerprints(exploded.withColumn(
        "h", F.explode(F.array_repeat("h", F.col("weight").cast("int")))), [*key, "size"])
    of_items = fingerprints(item_shingles, ["item", "copy"])
    left = of_windows.select(*key, "size", "n", "mark", F.explode(blocks("mark", radius)).alias("b"))
    right = of_items.select("item", "copy", F.col("n").alias("n_item"),
                            F.col("mark").alias("item_mark"),
                            F.explode(blocks("mark", radius)).alias("b"))
    same_item = (F.col("l.item").eqNullSafe(F.col("r.item")) & (F.col("l.copy") == F.col("r.copy")))
    near = (left.alias("l").join(right.alias("r"), same_item & (F.col("l.b") == F.col("r.b")))
            .select(*[f"l.{c}" for c in (*key, "size", "n")], "n_item",
                    F.bit_count(F.col("mark").bitwiseXOR(F.col("item_mark"))).alias("distance"))
            .where(F.col("distance") <= radius).distinct())

    same = (F.col("e.item").eqNullSafe(F.col("w.item")) & (F.col("e.copy") == F.col("w.copy"))
            & (F.col("e.h") == F.col("w.h")))
    shared = (exploded.alias("e").join(weights.alias("w"), same)
              .groupBy(*[f"e.{c}" for c in key])
              .agg(F.sum(F.least("weight", "item_weight")).alias("least")))
    same_window = reduce(lambda x, y: x & y, [
        F.col(f"a.{c}").eqNullSafe(F.col(f"s.{c}")) for c in key])
    score = F.col("least") / (F.col("n") + F.col("n_item") - F.col("least"))
    judged = (near.alias("a").join(shared.alias("s"), same_window)
              .select(*[f"a.{c}" for c in key], "size", "distance", score.alias("similarity"))
              .where(F.col("similarity") >= similarity))
    return _best(judged.withColumnRenamed("size", "n_words"), ["d", "version", "item"])
