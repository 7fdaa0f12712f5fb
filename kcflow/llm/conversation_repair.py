"""Repair of conversations whose turns do not alternate.

Faults of a turn, of which the first counts: blank (nothing but white space),
duplicate (role and text were there before), truncated (the text does not end
in a sentence mark).  Edits: Keep (0), Rerole to user or assistant (3), Delete
(4; blank and duplicate turns must go), Insert an empty user or assistant turn
(3); a truncated turn that stays costs 3 more.  Sought are the cheapest edits
after which the role initials read (s?(ua)+)?, and of those the ASCII-least
audit, the initials of the edits in order.

Turns are sorted once by range, so a long conversation lies in many slices, and
cut into cells of at most CELL_TURNS turns.  Every cell is aligned by itself
(`alternation`), from every state the turns before it can leave to every state
it can leave behind.  Per conversation only the costs and the order of the
cells' plans are chained, 32 small numbers a cell; the plan of each cell then
goes back to its turns.  `repair_turns` gives one row per edit, wherever its
turn lies; `summaries` runs over a conversation's edits in order, because an
audit and a digest of a whole conversation cannot be had otherwise, and holds
no texts.

Defined results: a null role or text is one space, so such a text is blank;
turns without a number come first, equal numbers follow in order of role
and text, repeated rows are turns each (the later ones duplicates); rows without
a conv_id are one conversation, whose id stays null; roles count by their first
character, others than s, u and a are only rerolled or deleted; an empty table
gives an empty result.  Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kcflow.llm.alternation import (BLANK, DUPLICATE, FINE, FIRST_SYMBOL, OTHER, TRUNCATED, Chain,
                                    aligned)
from kcflow.llm.common import ASCII_SPACE, materialise
from kcflow.operators.sequence import sliced

#: Turns that are aligned at once.
CELL_TURNS = 32
#: Code points of role and text by which rows are dealt (they are sorted by all).
DEAL_CHARS = 64
SENTENCE_MARKS = ".!?"

FAULTS = ("fine", "blank", "duplicate", "truncated")


def damaged(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """The turns with faults put in by crc32("conv_id:turn") % 20 (nulls: one space):
    0 drops a turn, 1 empties its text, 2 takes its sentence marks, 3 repeats
    it, 4 makes its role user."""
    def or_space(c: str) -> Column:
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))

    kind = F.crc32(F.encode(F.concat(or_space(conv_id), F.lit(":"), or_space(turn)), "UTF-8")) % 20
    said = or_space(text)
    rows = turns.select(F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
                        or_space(role).alias("role"), said.alias("text"), kind.alias("kind"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where("kind != 0").select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(
            F.col("kind") == 2, F.translate("text", SENTENCE_MARKS, "")).otherwise(
                F.col("text")).alias("text"),
        F.explode(copies).alias("copy")).drop("copy")


def sorted_turns(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, role, text and at, which grows along each conversation."""
    rows = turns.select(
        F.col(f"`{conv_id}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"))
    by_turn = F.col("turn").asc_nulls_first()
    short = [F.substring(c, 1, DEAL_CHARS) for c in ("role", "text")]
    placed = sliced(rows, [F.col("conv"), by_turn, F.col("role"), F.col("text")],
                    deal=[F.col("conv"), by_turn, *short])
    return placed.select("conv", "turn", "role", "text", F.col("_kc_mid").alias("at"))


def with_faults(turns: DataFrame) -> DataFrame:
    """conv, at, initial (role class) and fault of each sorted turn."""
    body = F.rtrim("text", F.lit(ASCII_SPACE))
    facts = turns.select(
        "conv", "at", F.xxhash64("role", "text").alias("ha"), F.xxhash64("text", "role").alias("hb"),
        F.substring("role", 1, 1).alias("r"),
        (F.length(body) == 0).alias("blank"),
        F.instr(F.lit(SENTENCE_MARKS), F.right(body, F.lit(1))).alias("ends"))
    first = facts.groupBy("conv", "ha", "hb").agg(F.min("at").alias("at")).select(
        "at", F.lit(True).alias("first"))
    classes = F.coalesce(F.nullif(F.instr(F.lit("sua"), F.col("r")), F.lit(0)) - 1, F.lit(OTHER))
    return facts.join(first, "at", "left").select(
        "conv", "at", F.when(F.col("r") == "", OTHER).otherwise(classes).alias("initial"),
        F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), DUPLICATE)
        .when(F.col("ends") == 0, TRUNCATED).otherwise(FINE).alias("fault"))


def _aligned_cells(facts: DataFrame) -> DataFrame:
    """conv, at (of the first turn), costs, ranks, plans per cell."""
    symbol = F.char(F.col("initial") * 4 + F.col("fault") + FIRST_SYMBOL)
    cells = facts.groupBy("conv", F.floor(F.col("at") / CELL_TURNS).alias("cell")).agg(
        F.sort_array(F.collect_list(F.struct("at", symbol.alias("x")))).alias("turns"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [aligned(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([list(x[0]) for x in found], pa.list_(pa.int32())),
                 pa.array([list(x[1]) for x in found], pa.list_(pa.int32())),
                 pa.array([list(x[2]) for x in found], pa.list_(pa.string()))],
                names=["conv", "at", "costs", "ranks", "plans"])

    return materialise(cells.select(
        "conv", F.col("turns")[0]["at"].alias("at"), F.array_join("turns.x", "").alias("symbols"))
        .mapInArrow(align, "conv long, at long, costs array<int>, ranks array<int>, "
                           "plans array<string>"), "cells")


def _picked(cells: DataFrame) -> DataFrame:
    """at, pick (index of the plan taken) and tail of each cell."""

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, places, states = (), [], None
        picks: list[tuple[int, int, str]] = []

        def close() -> None:
            if states is not None:
                taken, tail = states.picks()
                picks.extend(zip(places, taken, [""] * (len(taken) - 1) + [tail], strict=True))

        def out() -> pa.RecordBatch:
            at, pick, tail = zip(*picks, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int64()), pa.array(pick, pa.int32()), pa.array(tail, pa.string())],
                names=["at", "pick", "tail"])

        for batch in batches:
            for conv, at, costs, ranks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (conv,) != now:
                    close()
                    now, places, states = (conv,), [], Chain()
                places.append(at)
                states.add(costs, ranks)
            if picks:
                yield out()
                picks.clear()
        close()
        if picks:
            yield out()

    dealt = cells.select("conv", "at", "costs", "ranks").repartition("conv")
    return dealt.sortWithinPartitions("conv", "at").mapInArrow(
        chain, "at long, pick int, tail string")


def repair_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """One row per edit: conv_id, at and k (their order), turn, initial (of the
    given turn, null for an insert), fault, edit (K, R, D or I), cost, and role
    and text of the repaired turn (null when it is deleted)."""
    given = sorted_turns(turns, conv_id, turn, role, text)
    facts = materialise(with_faults(given), "faults")
    cells = _aligned_cells(facts)
    plans = cells.select("at", "plans").join(_picked(cells), "at").select(
        "at", F.split(F.element_at("plans", F.col("pick") + 1), ",").alias("pieces"), "tail")
    pieces = plans.select(
        "at", "tail", F.size("pieces").alias("n"), F.posexplode("pieces").alias("i", "piece")).select(
            (F.col("at") + F.col("i")).alias("at"),
            F.concat("piece", F.when(F.col("i") == F.col("n") - 1, F.col("tail"))
                     .otherwise(F.lit(""))).alias("piece"))
    rows = given.join(facts.drop("conv").join(pieces, "at"), "at")
    step = F.split("piece", "")
    edits = rows.select("*", F.posexplode(F.filter(step, lambda x: x != "")).alias("k", "x"))
    x, own = F.col("x"), F.col("x").rlike("[KUAD]")
    letter = F.when(~own, "I").when(x.isin("U", "A"), "R").otherwise(x)
    price = (F.when(~own, 3).when(x == "D", 4).otherwise(
        F.when(x == "K", 0).otherwise(3) + F.when(F.col("fault") == TRUNCATED, 3).otherwise(0)))
    initial = F.substring("role", 1, 1)
    return edits.select(
        F.col("conv").alias("conv_id"), "at", "k", F.when(own, F.col("turn")).alias("turn"),
        F.when(own, initial).alias("initial"),
        F.when(own, F.element_at(F.array(*[F.lit(f) for f in FAULTS]), F.col("fault") + 1))
        .alias("fault"),
        letter.alias("edit"), price.cast("long").alias("cost"),
        F.when(x == "K", F.col("role")).when(F.lower(x) == "u", "user").when(
            F.lower(x) == "a", "assistant").alias("role"),
        F.when(x.isin("K", "U", "A"), F.col("text")).when(~own, "").alias("text"))


LEGAL = ("su", "ua", "au")


def summaries(edits: DataFrame) -> DataFrame:
    """Per conversation with turns: gaps, blank, duplicate, truncated, illegal,
    cost, audit and repaired_sha256 of the edits of `repair_turns`."""
    counted = ("blank", "duplicate", "truncated")
    longs = ("gaps", *counted, "illegal", "cost")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = (), None, []

        def close() -> None:
            if state is not None:
                turns, n = state["turns"], state["n"]
                gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
                done.append((now[0], gaps, *(n[c] for c in counted), n["illegal"], n["cost"],
                             "".join(state["audit"]), state["sha"].hexdigest()))

        def out() -> pa.RecordBatch:
            kinds = [pa.int64()] * 7 + [pa.string()] * 2
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)],
                names=["conv_id", *longs, "audit", "repaired_sha256"])

        for batch in batches:
            for conv, turn, initial, fault, edit, cost, role, text in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                if (conv,) != now:
                    close()
                    now, state = (conv,), {
                        "turns": None, "last": None, "audit": [], "sha": hashlib.sha256(),
                        "n": dict.fromkeys((*counted, "illegal", "cost"), 0), "lines": 0}
                n = state["n"]
                state["audit"].append(edit)
                n["cost"] += cost
                if initial is not None:
                    if fault in n:
                        n[fault] += 1
                    if state["last"] is not None and state["last"] + initial not in LEGAL:
                        n["illegal"] += 1
                    state["last"] = initial
                if turn is not None:
                    low, high, different = state["turns"] or (turn, None, 0)
                    state["turns"] = low, turn, different + (turn != high)
                if edit != "D":
                    line = f"{role}:{text}"
                    state["sha"].update(("\n" + line if state["lines"] else line).encode())
                    state["lines"] += 1
            if done:
                yield out()
                done.clear()
        close()
        if done:
            yield out()

    ordered = edits.repartition("conv_id").sortWithinPartitions("conv_id", "at", "k").select(
        "conv_id", F.col("turn").cast("long"), "initial", "fault", "edit", "cost", "role", "text")
    return ordered.mapInArrow(
        run, "conv_id long, " + ", ".join(f"{c} long" for c in longs)
        + ", audit string, repaired_sha256 string")
