"""Mixing sources to target weights.

The words of a source, document after document, are packed into blocks of
BLOCK_WORDS (the last one may be short).  A mix of N blocks is written as output
shards of SHARD_SLOTS slots.

- Targets: the mix holds `share` times all words; sources get it by weight, no
  source more than `most` times its own words, what is above goes to the
  others by weight.  The level (words per unit of weight) is found by Newton
  steps on sums over the table of sources.
- Draw: every slot of a shard draws a source with probability target / all, so
  a shard's counts are multinomial.  Chance leaves a source above or below its
  target; the last slots of those above go to those below, rank by rank, so
  totals meet the targets to one block and no cap is passed.
- Index: the k-th slot of a source takes block p(k mod n) of its n, with p a
  pseudorandom permutation (a Feistel network walked until it falls below n)
  that changes with each pass over the source.  So every block comes once
  before any comes twice.  Slots and blocks meet by (source, block).

Sources are numbered and added up over ranges, a source's words over hash
blocks of its documents; no source, shard or draw is one task's group, and
nothing but sums reaches the driver.

Defined results: a null text has no words; a null source is a source after all
others; a null doc_id is a value like others; repeated rows are documents each;
a document without words is in no block; an empty table, or one without a
word, gives an empty mix.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kcflow.llm.common import materialise
from kcflow.llm.numbering import ROWS_PER_BLOCK
from kcflow.operators.sequence import running_index

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
SHARE, MOST = 1.5, 2
BLOCK_WORDS = 64
SHARD_SLOTS = 4096
SEED = 11
#: Sources added up in one range of the running sums over sources.
RANK_RANGE = 4096
#: Units of the drawn line that are met at once.
LINE_CELL = 64


def n_words(text: str | Column) -> Column:
    text = F.col(f"`{text}`") if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def level(sources: DataFrame, share: float = SHARE, most: float = MOST) -> float:
    """Words per unit of weight with which all targets add up to `share` of the
    words: sum(min(most * size, weight * level)) = share * sum(size)."""
    total = sources.agg(F.sum("size")).first()[0] or 0
    now = 0.0
    while total:
        full = F.col("weight") * F.lit(now) >= most * F.col("size")
        held, weight = sources.agg(
            F.sum(F.when(full, most * F.col("size")).otherwise(0)),
            F.sum(F.when(~full, F.col("weight")).otherwise(0.0))).first()
        if not weight:
            break
        following = (share * total - held) / weight
        if following <= now:  # no further source is full
            break
        now = following
    return now


def running_sums(rows: DataFrame, by: str, sums: dict[str, str]) -> DataFrame:
    """Add the sum of earlier rows (in order of the gapless number `by`) of each
    column: `sums` maps the column to the new name."""
    ranged = rows.withColumn("_range", F.floor(F.col(by) / RANK_RANGE))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = ranged.groupBy("_range").agg(*[F.sum(c).alias(f"_{c}") for c in sums]).select(
        "_range", *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}")
                    for c in sums])  # a row per RANK_RANGE sources
    inside = Window.partitionBy("_range").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(shift, "_range").withColumns({
        name: (F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_{c}")).cast("long")
        for c, name in sums.items()}).drop("_range", *[f"_{c}" for c in sums])


def permuted(k: pd.Series, n: pd.Series, key: pd.Series) -> pd.Series:
    """A permutation of 0 .. n - 1 chosen by `key`, at k: four Feistel rounds on
    the least even number of bits that holds n, walked until below n."""
    n, key = n.to_numpy(np.uint64), key.to_numpy(np.int64).view(np.uint64)
    bits = np.maximum(1, np.ceil(np.ceil(np.log2(np.maximum(n.astype(np.float64), 2))) / 2))
    half = bits.astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = k.to_numpy(np.uint64).copy(), np.arange(len(n))
    with np.errstate(over="ignore"):
        while todo.size:
            h, m, x = half[todo], mask[todo], out[todo]
            left, right = x >> h, x & m
            for turn in range(4):
                f = (right + np.uint64(turn + 1) + key[todo]) * np.uint64(0x9E3779B97F4A7C15)
                f ^= f >> np.uint64(31)
                f *= np.uint64(0xBF58476D1CE4E5B9)
                f ^= f >> np.uint64(29)
                left, right = right, left ^ (f & m)
            out[todo] = (left << h) | right
            todo = todo[out[todo] >= n[todo]]
    return pd.Series(out.astype(np.int64))


@dataclass
class Mix:
    """The plan of a mix.

    docs: the document's row (doc_id, source), size, source_size, target, start
    (its words' place in the source) and rank (of the source);
    sources: source, rank, weight, size, target, blocks, quota;
    slots: shard, slot, rank, block (which block of which source).
    """

    docs: DataFrame
    sources: DataFrame
    slots: DataFrame
    block_words: int

    def pieces(self) -> DataFrame:
        """rank, block, doc_id, start (which tell documents apart), skip (words of
        the document before) and words: the parts of documents in each block."""
        b, start, end = self.block_words, F.col("start"), F.col("start") + F.col("size")
        blocks = F.sequence(F.floor(start / b), F.floor((end - 1) / b))
        parts = self.docs.where("size > 0").select(
            "rank", "doc_id", "start", "size", F.explode(blocks).alias("block"))
        low = F.greatest(start, F.col("block") * b)
        return parts.select("rank", "block", "doc_id", "start",
                            (low - start).alias("skip"),
                            (F.least(end, (F.col("block") + 1) * b) - low).alias("words"))

    def mixed(self) -> DataFrame:
        """The mix: shard, slot and the parts of documents in that slot's block."""
        return self.slots.join(self.pieces(), ["rank", "block"])

    def texts(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """shard, slot and the block's words joined by a space.

        `docs` must be the documents that the mix was planned for."""
        words = F.regexp_extract_all(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(WORD), F.lit(0))
        said = _keyed(docs, *self._names, text).withColumn("_words", words)
        keys = ["_source", "_id", "_size", "_check"]
        placed = self.docs.select("rank", "start", *keys)
        same = F.lit(True)
        for c in keys:
            same = same & said[c].eqNullSafe(placed[c])
        # equal rows have equal words: any of them stands for any place
        own = said.dropDuplicates(keys).join(placed, same).select("rank", "start", "_words")
        own = own.withColumnRenamed("start", "from")
        cut = self.pieces().withColumnRenamed("start", "from").join(own, ["rank", "from"]).select(
            "rank", "block", "from",
            F.array_join(F.slice("_words", F.col("skip").cast("int") + 1,
                                 F.col("words").cast("int")), " ").alias("part"))
        joined = cut.groupBy("rank", "block").agg(F.array_join(F.transform(
            F.sort_array(F.collect_list(F.struct("from", "part"))), lambda x: x["part"]), " ")
            .alias("text"))  # block_words parts at most
        return self.slots.join(joined, ["rank", "block"]).select("shard", "slot", "text")

    _names: tuple[str, str] = ("doc_id", "source")


def _keyed(docs: DataFrame, doc_id: str, source: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(
        F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{source}`").cast("string").alias("_source"),
        n_words(text).alias("_size"), F.xxhash64(body).alias("_check"),
        F.col(f"`{text}`").alias(text))


def plan_mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
             weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST,
             block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS,
             seed: int = SEED) -> Mix:
    """Plan a mix of all documents; `weights` go to the sources in order, again
    and again."""
    spark = docs.sparkSession
    rows = materialise(_keyed(docs, doc_id, source, text).drop(text), "sizes")
    # words before a document in its source: hash blocks, then the blocks' sums
    blocks = rows.count() // ROWS_PER_BLOCK + 1
    order = ["_id", "_check", "_size"]
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(blocks)))
    inside = Window.partitionBy("_source", "_part").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    local = dealt.withColumn("_before", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    parts = materialise(dealt.groupBy("_source", "_part").agg(F.sum("_size").alias("_n")), "parts")

    by_source = parts.groupBy("_source").agg(F.sum("_n").alias("size"))
    ranked = running_index(by_source, [], [F.col("_source").asc_nulls_last()], "rank")
    ranked = materialise(ranked.withColumn("rank", F.col("rank") - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                               (F.col("rank") % len(weights) + 1).cast("int"))), "ranked")
    per_weight = level(ranked, share, most)
    target = F.least(F.lit(float(most)) * F.col("size"), F.col("weight") * F.lit(per_weight))
    n_blocks = F.ceil(F.col("size") / block_words)
    # a block counts as the source's mean block, the last one may be short
    quota = F.least(F.round(F.try_divide(target * n_blocks, F.col("size"))), most * n_blocks)
    sources = materialise(ranked.withColumns({
        "target": target, "blocks": n_blocks,
        "quota": F.coalesce(quota, F.lit(0)).cast("long")}), "sources")

    earlier = Window.partitionBy("_source").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    shift = parts.select("_source", "_part",
                         F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    facts = sources.select(F.col("_source").alias("_s"), "rank",
                           F.col("size").alias("source_size"), "target")
    # a row per (source, hash block): what is joined to the documents is spread likewise
    shift = shift.join(facts, F.col("_source").eqNullSafe(F.col("_s"))).select(
        F.col("_source").alias("_s"), F.col("_part").alias("_p"), "_shift", "rank",
        "source_size", "target")
    placed = local.join(shift, F.col("_source").eqNullSafe(F.col("_s"))
                        & (F.col("_part") == F.col("_p"))).select(
        F.col("_id").alias("doc_id"), "_id", "_source", "_size", "_check",
        F.col("_size").alias("size"), "source_size", "target", "rank",
        (F.col("_before") + F.col("_shift")).alias("start"))
    mix = Mix(materialise(placed, "placed"), sources,
              _slots(spark, sources, shard_slots, seed), block_words)
    mix._names = (doc_id, source)
    return mix


def _slots(spark, sources: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """shard, slot, rank and block of every slot of the mix."""
    total = sources.agg(F.sum("quota")).first()[0] or 0
    lined = running_sums(sources.select("rank", "blocks", "quota"), "rank", {"quota": "low"})
    high = F.col("low") + F.col("quota")
    # the line 0 .. total, a unit per wanted block: a slot draws a unit
    line = lined.where("quota > 0").select(
        "rank", "low", high.alias("high"), F.explode(F.sequence(
            F.floor(F.col("low") / LINE_CELL), F.floor((high - 1) / LINE_CELL))).alias("cell"))
    unit = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(1, total)))
    draws = spark.range(total).select(
        F.floor(F.col("id") / shard_slots).alias("shard"), unit.alias("unit"),
        F.floor(unit / LINE_CELL).alias("cell"))
    counts = materialise(draws.join(line, "cell").where("low <= unit AND unit < high").groupBy(
        "rank", "shard").agg(F.count(F.lit(1)).alias("n")), "draws")
    earlier = Window.partitionBy("rank").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1)
    drawn = counts.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0))).select(
        "rank", "shard", F.explode(F.transform(
            F.sequence(F.lit(0).cast("long"), F.col("n") - 1),
            lambda i: F.col("first") + i)).alias("k"))
    # what a source drew above its quota, and what it lacks, both numbered over the sources
    totals = counts.groupBy("rank").agg(F.sum("n").alias("drawn"))
    judged = materialise(running_sums(
        lined.join(totals, "rank", "left").select(
            "rank", "quota", "blocks", F.coalesce("drawn", F.lit(0)).alias("drawn"),
            F.greatest(F.lit(0), F.coalesce("drawn", F.lit(0)) - F.col("quota")).alias("over"),
            F.greatest(F.lit(0), F.col("quota") - F.coalesce("drawn", F.lit(0))).alias("under")),
        "rank", {"over": "over_before", "under": "under_before"}), "judged")
    lacking = judged.where("under > 0").select(
        F.col("rank").alias("to"), "drawn", "under_before", F.col("blocks").alias("to_blocks"),
        F.posexplode(F.sequence(
            F.floor(F.col("under_before") / LINE_CELL),
            F.floor((F.col("under_before") + F.col("under") - 1) / LINE_CELL))).alias("_", "cell"),
        (F.col("under_before") + F.col("under")).alias("under_end"))
    own = judged.select("rank", "quota", "blocks", "over_before")
    slots = drawn.join(own, "rank")
    kept = slots.where("k < quota").select("shard", "rank", "k", "blocks")
    given = slots.where("k >= quota").withColumn(
        "place", F.col("over_before") + F.col("k") - F.col("quota")).withColumn(
            "cell", F.floor(F.col("place") / LINE_CELL))
    moved = given.join(lacking, "cell").where(
        "under_before <= place AND place < under_end").select(
            "shard", F.col("to").alias("rank"),
            (F.col("drawn") + F.col("place") - F.col("under_before")).alias("k"),
            F.col("to_blocks").alias("blocks"))
    chosen = kept.unionByName(moved)
    turn = F.floor(F.col("k") / F.col("blocks"))
    block = F.pandas_udf(permuted, "long")(F.col("k") % F.col("blocks"), F.col("blocks"),
                                           F.xxhash64(F.lit(seed), "rank", turn))
    in_shard = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "rank", "k"), "rank", "k")
    return materialise(chosen.select(  # a shard has shard_slots rows at most
        "shard", (F.row_number().over(in_shard) - 1).alias("slot"), "rank", block.alias("block")),
        "slots")


def taken(mix: Mix) -> DataFrame:
    """doc_id, size, source_size, target and taken: the words of each document
    that the mix takes, repeats counted."""
    # a document's parts lie side by side in its source; (rank, start) tells documents with words apart
    sums = mix.mixed().groupBy("rank", "start").agg(F.sum("words").alias("taken"))
    found = F.col("size") > 0
    joined = mix.docs.join(sums.select(F.col("rank").alias("_r"), F.col("start").alias("_at"),
                                       "taken"),
                           found & (F.col("rank") == F.col("_r")) & (F.col("start") == F.col("_at")),
                           "left")
    return joined.select("doc_id", "size", "source_size", "target",
                         F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
