import random
import zlib
from functools import lru_cache

import pytest

from kcflow.llm import alternation, conversation_repair
from kcflow.llm.alternation import Chain, aligned, audit_of
from kcflow.llm.conversation_repair import damaged, repair_turns, summaries
from kcflow.llm.queries import op12_conversation_repair
from tests.conftest import SF_SMALL
from tests.llm.conftest import sha

SCHEMA = "conv_id long, turn long, role string, text string, conv long, at long, k string"
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
           "repaired_sha256")
SPACE = " \t\n\x0b\x0c\r"


def cheapest(turns):
    """(cost, audit, roles) of turns (initial, fault): every way from every state."""

    @lru_cache(None)
    def rest(i, state, inserted):
        ways = []
        for to, role in ((s, r) for s, r in zip("ua", ("user", "assistant")) if state + s in
                         ("u", "su", "ua", "au")):
            if inserted < 2:
                c, a, out = rest(i, to, inserted + 1)
                ways.append((c + 3, "I" + a, ((None, role), *out)))
        if i == len(turns):
            if state in ("", "a"):
                ways.append((0, "", ()))
        else:
            initial, fault = turns[i]
            c, a, out = rest(i + 1, state, 0)
            ways.append((c + 4, "D" + a, out))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                for s in "sua":
                    if state + s not in ("s", "u", "su", "ua", "au"):
                        continue
                    if s == initial:
                        c, a, out = rest(i + 1, s, 0)
                        ways.append((c + more, "K" + a, ((i, None), *out)))
                    elif s != "s":
                        c, a, out = rest(i + 1, s, 0)
                        ways.append((c + more + 3, "R" + a, (
                            (i, "user" if s == "u" else "assistant"), *out)))
        return min(ways, key=lambda w: w[:2], default=(10**9, "", ()))
    return rest(0, "", 0)


def plain(rows):
    """Of one conversation: rows (turn, role, text) after damage, in order."""
    turns, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip(SPACE)
        fault = ("blank" if not body else "duplicate" if (role, text) in seen
                 else "truncated" if body[-1] not in ".!?" else "fine")
        seen.add((role, text))
        turns.append((role[:1], fault))
    cost, audit, out = cheapest(tuple(turns))
    lines = [f"{role or rows[i][1]}:{rows[i][2]}" if i is not None else f"{role}:"
             for i, role in out]
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(turns, turns[1:]))
    return (gaps, *(sum(f == k for _, f in turns) for k in ("blank", "duplicate", "truncated")),
            illegal, cost, audit, sha("\n".join(lines).encode()))


def plain_damage(rows):
    convs = {}
    for c, t, r, x in rows:
        own = convs.setdefault(c, [])
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if kind == 1 else "".join(ch for ch in x if ch not in ".!?") if kind == 2 else x
        if kind:
            own += [(t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    return {c: sorted(own, key=lambda z: (z[0] is not None, z[0] or 0, z[1], z[2]))
            for c, own in convs.items()}


@pytest.mark.parametrize("cell", [1, 3, 32])
def test_chained_alignments(cell):
    """Against every way, for conversations cut into cells."""
    rng = random.Random(cell)
    letters, faults = "sua?", ("fine", "blank", "duplicate", "truncated")
    for case in range(1500):
        turns = [(rng.choice("suauaua?"), rng.choice(faults if case % 3 else ("fine",)))
                 for _ in range(rng.randint(1, 9))]
        symbols = "".join(chr(alternation.FIRST_SYMBOL + 4 * letters.index(r) + faults.index(f))
                          for r, f in turns)
        chain, plans = Chain(), []
        for i in range(0, len(symbols), cell):
            costs, ranks, own = aligned(symbols[i:i + cell])
            chain.add(costs, ranks)
            plans.append(own)
        picks, tail = chain.picks()
        audit = "".join(audit_of(p[k]) for p, k in zip(plans, picks)) + "I" * len(tail)
        cost, want, _ = cheapest(tuple(turns))
        assert audit == want, (turns, audit, want)


def odd_rows():
    talk = [(i, "user" if i % 2 == 0 else "assistant", f"text {i}.") for i in range(9)]
    rng = random.Random(5)
    long = [(i, rng.choice(["user", "assistant", "system", "tool"]),
             rng.choice(["A line.", f"Number {i}", f"Ends {i}!", " \n", "Why é?"]))
            for i in range(150)]
    convs = {1: talk, 2: talk[:1], 3: talk[1:4] + talk[6:], 4: [(0, "system", "Be.")] + talk[1:],
             5: [(0, None, "x."), (0, "user", None), (None, "user", "first."), (0, None, "x.")],
             6: [(0, "", "t."), (1, "", "t.")], 7: [(None, None, None)], 8: long,
             9: [(i, "assistant", f"said {i}?\n\t") for i in range(70)],
             None: talk[:5] + [(7, "user", "last")], 10: [(2**40, "user", "."), (0, "user", ".")]}
    return [(c, t, r, x, 1, 1, "a") for c, turns in convs.items() for t, r, x in turns]


def result(df):
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in df.collect()}


@pytest.mark.parametrize("cell", [32, 4])
def test_summaries(worker_path, monkeypatch, cell):
    monkeypatch.setattr(conversation_repair, "CELL_TURNS", cell)
    data = odd_rows()
    df = worker_path.createDataFrame(data, SCHEMA).repartition(3)
    whole = {}
    for c, t, r, x, *_ in data:
        whole.setdefault(c, []).append((t, " " if r is None else r, " " if x is None else x))
    ordered = {c: sorted(v, key=lambda z: (z[0] is not None, z[0] or 0, z[1], z[2]))
               for c, v in whole.items()}
    assert result(summaries(repair_turns(df))) == {c: plain(v) for c, v in ordered.items()}
    hurt = plain_damage([r[:4] for r in data])
    assert result(summaries(repair_turns(damaged(df)))) == {
        c: plain(v) for c, v in hurt.items() if v}


def test_repaired_turns_fit_the_grammar(worker_path):
    import re
    df = worker_path.createDataFrame(odd_rows(), SCHEMA)
    edits = repair_turns(df).orderBy("at", "k").collect()
    for conv in {e.conv_id for e in edits}:
        roles = "".join(e.role[0] for e in edits if e.conv_id == conv and e.edit != "D")
        assert re.fullmatch("(s?(ua)+)?", roles)


def test_empty_table(worker_path):
    empty = worker_path.createDataFrame([], SCHEMA)
    assert repair_turns(damaged(empty)).collect() == []
    assert summaries(repair_turns(empty)).collect() == []


def test_query_agrees_with_plain(worker_path):
    import pyarrow.parquet as pq
    t = pq.read_table(f"{SF_SMALL}/conversations.parquet").to_pylist()
    hurt = plain_damage([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in t])
    want = {c: plain(v) if v else (0, 0, 0, 0, 0, 0, "", sha(b"")) for c, v in hurt.items()}
    assert result(op12_conversation_repair(worker_path, SF_SMALL)) == want
