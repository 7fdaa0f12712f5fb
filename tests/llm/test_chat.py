import duckdb
import pytest

from kcflow.llm import chat
from kcflow.llm.chat import format_chats
from kcflow.llm.queries import CHAT_SQL, op5_chat_formatting
from tests.conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string, conv string, block long, n long"


def turns(*convs):
    return [(c, t, r, x, "c", 1, 1) for c, rows in convs for t, r, x in rows]


def talk(n, text="t"):
    return [(i, "user" if i % 2 == 0 else "assistant", f"{text}{i}") for i in range(n)]


def plain(rows):
    convs = {}
    for c, t, r, x in set(rows):
        convs.setdefault(c, []).append((t is not None, t or 0, r is not None, r or "",
                                        x is not None, x or ""))
    whole = {c: [z[2:] for z in sorted(v)] for c, v in convs.items()}
    return {c: v for c, v in whole.items() if not any(
        (len(w) > len(v) and w[:len(v)] == v) or (w == v and (k is not None and (
            c is None or k < c))) for k, w in whole.items() if k != c)}


@pytest.mark.parametrize("block", [512, 3])
def test_snapshots(worker_path, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK_TURNS", block)
    rows = turns((1, talk(2)), (2, talk(4)), (3, talk(9)), (4, talk(9)), (5, talk(9, "u")),
                 (6, [(0, "user", None), (0, None, "x"), (None, "user", "first")]),
                 (7, [(10 + t, r, x) for t, r, x in talk(3)]), (None, talk(1, "v")),
                 (10, [(0, "user", None), (1, "a", "b")]), (11, [(0, None, "user"), (1, "a", "b")]),
                 (8, talk(1, "v") + talk(1, "v")), (9, [(0, "user", "")]))
    df = worker_path.createDataFrame(rows, SCHEMA).repartition(3)
    got = {}
    for r in sorted(format_chats(df).collect(), key=lambda r: (str(r.conv_id), r.part)):
        got.setdefault(r.conv_id, []).append(r)
    want = plain([r[:4] for r in rows])
    assert set(got) == set(want)
    for c, parts in got.items():
        text = "\n".join(p.text for p in parts)
        assert text == "\n".join(f"<|im_start|>{r if k else 'unknown'}\n{x}<|im_end|>"
                                 for k, r, _, x in want[c])
        assert {p.n_turns for p in parts} == {len(want[c])}
        assert [p.part for p in parts] == list(range(len(parts)))


def test_empty_table(worker_path):
    assert format_chats(worker_path.createDataFrame([], SCHEMA)).collect() == []


def test_query_agrees_with_sql(worker_path):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS FROM read_parquet('{SF_SMALL}/conversations.parquet')")
    want = con.sql(f"SELECT conv_id, part, n_turns, turns, text FROM ({CHAT_SQL})").fetchall()
    assert {tuple(r) for r in op5_chat_formatting(worker_path, SF_SMALL).collect()} == set(want)
