"""Prefix trie of conversations by van Emde Boas recursion.

A turn is reduced to two 64-bit hashes of (role, text) and the code points of
its text; texts do not move after that.  A trie whose sequences have up to H
turns is cut at half its depth: the first H/2 turns of each sequence go into
the upper trie, the rest into the lower tries, one for each different cut
prefix.  The cut prefix is named by a digest of the name of the trie's top and
the turns above the cut, and this name is the top of its lower trie.  All
tries of one height are cut in the same step, upper and lower ones alike, down
to height one, where the top of a turn is its parent's name.

Totals come back in the other direction.  With every trie of height m solved,
one of height 2m is its upper trie with the totals of the lower tries added
(grafted) at the cut: the total of each lower trie goes to the nodes above
its top, up to the top of the trie of height 2m.  They are met along one member
conversation, so a step adds at most m rows per cut and the whole work is
(turns) x log(depth).

Nothing is gathered per conversation.  Cuts above BLOCK_TURNS are made on one
row per block of that many turns, those below inside (conversation, block).
Members that end at a node are joined in ranges of ids; only the digest of the
list runs over a node's ranges one by one, as a digest must.

Defined results: a null role or text is empty; turns without a number come
first, equal numbers follow in order of role and text, repeated rows are turns
each; rows without a conv_id are one conversation after all others, whose
conv_id is null and whose id is left out of digests; a conversation without
turns is a member of the root; an empty table has no node, not even the
root.  Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kcflow.llm.common import LAST_ID, id_back, id_key, materialise
from kcflow.operators.sequence import running_index

#: Turns of one block: cuts below this height are made inside the block.
BLOCK_TURNS = 512
#: Width of the id ranges in which members are joined.
ID_RANGE = 4096
#: Code points of role and text by which rows are dealt (they are sorted by all).
DEAL_CHARS = 64

NAME = ["a", "b"]


def turn_symbols(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """conv (id key), d (1, 2 ... in its conversation), ha, hb (hashes of role
    and text) and chars (code points of the text)."""
    rows = turns.select(id_key(f"`{conv_id}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
                        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
                        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.withColumns({"ha": F.xxhash64("role", "text"), "hb": F.xxhash64("text", "role"),
                             "chars": F.length("text").cast("long")})
    by_turn = F.col("turn").asc_nulls_first()
    short = [F.substring(c, 1, DEAL_CHARS) for c in ("role", "text")]
    return running_index(rows, ["conv"], [by_turn, "role", "text"], "d",
                         keep=["ha", "hb", "chars"], deal=[F.col("conv"), by_turn, *short])


def _joined(top_a: Column, top_b: Column, xa: Column, xb: Column) -> tuple[Column, Column]:
    """The name of a prefix: the top of its trie and the turns below it."""
    return F.xxhash64(top_a, xa), F.xxhash64(xb, top_b)


def cut_names(units: DataFrame, key: list[str], height: int) -> DataFrame:
    """Cut the tries of `height` units below (key, top) down to single units.

    units: key columns, i (0 to height - 1), xa, xb (digest of the unit), and
    the name of the top in top_a, top_b.  Afterwards the top is the name of
    everything before the unit, and a, b that of everything up to it (null
    for the last of `height` units, whose prefix the caller cuts).
    """
    rows = units.withColumns({"a": F.lit(None).cast("long"), "b": F.lit(None).cast("long")})
    half = height // 2
    while half:
        trie = Window.partitionBy(*key, "trie")
        rows = rows.withColumn("trie", F.floor(F.col("i") / (2 * half)))
        at = F.col("i") % (2 * half)  # place inside the trie
        above = at < half
        cut_a, cut_b = _joined(F.col("top_a"), F.col("top_b"),
                               F.bit_xor(F.when(above, F.col("xa"))).over(trie),
                               F.bit_xor(F.when(above, F.col("xb"))).over(trie))
        rows = rows.withColumns({"cut_a": cut_a, "cut_b": cut_b})
        rows = rows.withColumns({
            "a": F.when(at == half - 1, F.col("cut_a")).otherwise(F.col("a")),
            "b": F.when(at == half - 1, F.col("cut_b")).otherwise(F.col("b")),
            "top_a": F.when(above, F.col("top_a")).otherwise(F.col("cut_a")),
            "top_b": F.when(above, F.col("top_b")).otherwise(F.col("cut_b"))})
        rows = rows.drop("cut_a", "cut_b", "trie")
        half //= 2
    return rows


def _height(n: int) -> int:
    return 1 << max(0, n - 1).bit_length()


def named_prefixes(symbols: DataFrame, depth: int) -> DataFrame:
    """conv, d, a, b (name of the first d turns), pa, pb (of the first d - 1), chars."""
    block_turns = min(BLOCK_TURNS, _height(depth))
    rows = symbols.select(
        "conv", "d", "chars", F.floor((F.col("d") - 1) / block_turns).alias("block"),
        ((F.col("d") - 1) % block_turns).alias("i"),
        # with its depth, so that the digest of several turns tells their order
        F.xxhash64("d", "ha").alias("xa"), F.xxhash64("hb", "d").alias("xb"))
    root = {"top_a": F.lit(0).cast("long"), "top_b": F.lit(0).cast("long")}
    blocks = rows.groupBy("conv", "block").agg(
        F.bit_xor("xa").alias("xa"), F.bit_xor("xb").alias("xb")).withColumnRenamed("block", "i")
    height = _height(-(-depth // block_turns))
    blocks = cut_names(blocks.withColumns(root), ["conv"], height)
    last_a, last_b = _joined(F.col("top_a"), F.col("top_b"), F.col("xa"), F.col("xb"))
    blocks = blocks.select("conv", F.col("i").alias("block"), "top_a", "top_b",
                           F.coalesce("a", last_a).alias("last_a"),
                           F.coalesce("b", last_b).alias("last_b"))
    inside = cut_names(rows.join(blocks, ["conv", "block"]), ["conv", "block"], block_turns)
    full = F.col("i") == block_turns - 1  # the prefix is the block's own
    return inside.select("conv", "d", F.when(full, F.col("last_a")).otherwise(F.col("a")).alias("a"),
                         F.when(full, F.col("last_b")).otherwise(F.col("b")).alias("b"),
                         F.col("top_a").alias("pa"), F.col("top_b").alias("pb"), "chars")


def grafted(rows: DataFrame, nodes: DataFrame, depth: int) -> DataFrame:
    """(a, b, d, saved, leaves): parts that add up to each node's subtree totals.

    rows: conv, d, a, b, pa, pb; nodes: a, b, d, pa, pb, conv (a member),
    saved and leaves of the node alone.
    """
    columns = ["a", "b", "d", "pa", "pb", "conv", "saved", "leaves"]
    parts = nodes.select(*columns)
    half = 1
    while half < depth:
        # nodes below a cut: the tops of the lower tries' trees
        below = parts.where((F.col("d") - 1) % (2 * half) == half)
        cuts = below.groupBy("pa", "pb", F.col("d").alias("below")).agg(
            F.min("conv").alias("conv"), F.sum("saved").alias("saved"),
            F.sum("leaves").alias("leaves"))
        # the nodes above it in the upper trie have the depths below - half to below - 1
        cell = min(half, BLOCK_TURNS)
        cells = F.sequence(((F.col("below") - 1 - half) / cell).cast("long"),
                           ((F.col("below") - 2) / cell).cast("long"))
        wanted = cuts.select("conv", "saved", "leaves", F.explode(cells).alias("cell"))
        above = rows.where((F.col("d") - 1) % (2 * half) < half).withColumn(
            "cell", ((F.col("d") - 1) / cell).cast("long"))
        added = above.join(wanted, ["conv", "cell"]).groupBy("a", "b", "d").agg(
            F.first("pa").alias("pa"), F.first("pb").alias("pb"), F.min("conv").alias("conv"),
            F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
        parts = parts.unionByName(materialise(added.select(*columns), "grafts"))
        half *= 2
    return parts.select("a", "b", "d", "saved", "leaves", "pa", "pb")


def _digests(parts: DataFrame) -> DataFrame:
    """ends_sha256 of (a, b, d, part, ids): a node's id lists in order of part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None

        def out(keys: list[tuple], hashes: list[str]) -> pa.RecordBatch:
            columns = list(zip(*keys, strict=True)) or [(), (), ()]
            return pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns), pa.array(hashes, pa.string())],
                names=["a", "b", "d", "ends_sha256"])

        for batch in batches:
            keys, hashes = [], []
            for *key, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True):
                if key != now:
                    if now is not None:
                        keys.append(now)
                        hashes.append(digest.hexdigest())
                    now, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if keys:
                yield out(keys, hashes)
        if now is not None:
            yield out([now], [digest.hexdigest()])

    dealt = parts.select("a", "b", "d", "part", "ids").repartition("a", "b", "d")
    return dealt.sortWithinPartitions("a", "b", "d", "part").mapInArrow(
        run, "a long, b long, d long, ends_sha256 string")


def build_trie(symbols: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie over `symbols` (conv, d, ha, hb, chars).

    convs: conv, every conversation once, with or without turns.  Returns
    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256.
    """
    spark = symbols.sparkSession
    symbols = materialise(symbols, "symbols")
    depth = symbols.agg(F.max("d")).first()[0] or 0
    whole = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")).first()
    if not whole.n:
        return spark.createDataFrame(
            [], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
                "n_leaves long, saved_tokens long, ends_sha256 string")
    rows = materialise(named_prefixes(symbols, depth), "prefixes")
    here = materialise(rows.groupBy("a", "b", "d").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv"),
        F.first("pa").alias("pa"), F.first("pb").alias("pb"), F.first("chars").alias("chars")),
        "nodes")
    children = here.groupBy(F.col("pa").alias("a"), F.col("pb").alias("b"),
                            (F.col("d") - 1).alias("d")).agg(
        F.count(F.lit(1)).alias("n_children"))
    root = spark.createDataFrame([(0, 0, 0, whole.n, whole.conv)],
                                 "a long, b long, d long, n_convs long, conv long")
    nodes = materialise(here.unionByName(root, allowMissingColumns=True).join(
        children, ["a", "b", "d"], "left").withColumns({
            "n_children": F.coalesce("n_children", F.lit(0)),
            "saved": (F.col("n_convs") - 1) * F.coalesce("chars", F.lit(0)),
            "leaves": F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long")}),
        "counted-nodes")
    below_root = nodes.where("d > 0")
    parts = grafted(rows, below_root, depth)
    of_root = parts.where("d = 1").select(  # the last graft: everything below the root
        F.col("pa").alias("a"), F.col("pb").alias("b"), F.lit(0).cast("long").alias("d"),
        "saved", "leaves")
    totals = parts.select("a", "b", "d", "saved", "leaves").unionByName(of_root).unionByName(
        nodes.where("d = 0").select("a", "b", "d", "saved", "leaves")).groupBy(
            "a", "b", "d").agg(F.sum("saved").alias("saved_tokens"),
                               F.sum("leaves").alias("n_leaves"))
    lengths = symbols.groupBy("conv").agg(F.max("d").alias("d"))
    ends = rows.join(lengths, ["conv", "d"]).select("a", "b", "d", "conv").unionByName(
        convs.join(lengths, "conv", "left_anti").select(
            *[F.lit(0).cast("long").alias(c) for c in ("a", "b", "d")], "conv"))
    listed = ends.where(F.col("conv") != LAST_ID).groupBy(
        "a", "b", "d", F.floor(F.col("conv") / ID_RANGE).alias("part")).agg(
            F.array_join(F.transform(F.sort_array(F.collect_list("conv")),
                                     lambda c: c.cast("string")), ",").alias("ids"))
    parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"),
                           (F.col("d") + 1).alias("d"), F.col("conv").alias("parent"))
    out = nodes.drop("saved", "leaves").join(totals, ["a", "b", "d"]).join(
        _digests(listed), ["a", "b", "d"], "left")
    # the root may have a third of all nodes as children: its id is one number
    deep = out.where("d > 1").join(parents.where("d > 1"), ["pa", "pb", "d"])
    flat = out.where("d <= 1").withColumn("parent", F.when(F.col("d") == 1, F.lit(whole.conv)))
    return deep.unionByName(flat).select(
        id_back("conv").alias("conv_id"), F.col("d").alias("depth"),
        id_back("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))
        .alias("ends_sha256"))


def conversation_trie(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                      role: str = "role", text: str = "text") -> DataFrame:
    """The prefix trie of the conversations of a turns table (see `build_trie`)."""
    convs = turns.select(id_key(f"`{conv_id}`").alias("conv")).distinct()
    return build_trie(turn_symbols(turns, conv_id, turn, role, text), convs)


def rebuilt(symbols: DataFrame, convs: DataFrame, most: int = 6, span: int = 100) -> DataFrame:
    """Symbols of conversations that begin like another one.

    With h = crc32(decimal id) % `most`, a conversation c gets the first h turns
    of c - c % `span` (all if fewer) in place of its own first h.  The one
    without an id stays as it is.
    """
    conv = F.col("conv")
    h = F.when(conv == LAST_ID, 0).otherwise(
        F.crc32(F.encode(conv.cast("string"), "UTF-8")) % most)
    base = F.when(conv == LAST_ID, conv).otherwise(conv - conv % span)
    heads = symbols.where(F.col("d") < most)
    plan = convs.select("conv", h.alias("h"), base.alias("base")).where("h > 0")
    first = heads.withColumnRenamed("conv", "base").join(plan, "base").where("d <= h").select(
        "conv", "d", "ha", "hb", "chars")
    # turns that the other conversation has, up to h
    taken = heads.groupBy(F.col("conv").alias("base")).agg(F.max("d").alias("n"))
    shift = plan.join(taken, "base", "left").select(
        "conv", (F.col("h") - F.least("h", F.coalesce("n", F.lit(0)))).alias("missing")).where(
            "missing > 0")
    own = symbols.where(F.col("d") > h).join(shift, "conv", "left").select(
        "conv", (F.col("d") - F.coalesce("missing", F.lit(0))).alias("d"), "ha", "hb", "chars")
    return own.unionByName(first)
