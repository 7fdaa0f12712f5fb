import duckdb
import pytest
import zlib

from kcflow.llm import prefix_trie
from kcflow.llm.common import id_key
from kcflow.llm.prefix_trie import build_trie, conversation_trie, rebuilt, turn_symbols
from kcflow.llm.queries import TRIE_SQL, op13_prefix_trie
from tests.conftest import SF_SMALL
from tests.llm.conftest import sha

SCHEMA = "conv_id long, turn long, role string, text string, conv long, d long, a string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256")


def sequences(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    return {c: [z[2:] for z in sorted(v)] for c, v in convs.items()}


def begin_alike(own):
    out = {}
    for c, turns in own.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 6
        out[c] = (own.get(c - c % 100, [])[:h] if c is not None else []) + turns[h:]
    return out


def plain(seqs):
    """The trie node by node, each with its members."""
    nodes = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    key = {n: min((c for c in cs if c is not None), default=None) for n, cs in nodes.items()}
    kids = {n: [m for m in nodes if len(m) == len(n) + 1 and m[:len(n)] == n] for n in nodes}

    def below(n):
        return [n] + [m for k in kids[n] for m in below(k)]

    out = set()
    for n, cs in nodes.items():
        sub = below(n)
        ends = sorted(c for c in cs if c is not None and len(seqs[c]) == len(n))
        out.add((key[n], len(n), key[n[:-1]] if n else None, len(cs), len(kids[n]),
                 sum(not kids[m] for m in sub),
                 sum((len(nodes[m]) - 1) * len(m[-1][1]) for m in sub if m),
                 sha(",".join(map(str, ends)).encode())))
    return out


def result(df):
    return [tuple(r[c] for c in COLUMNS) for r in df.collect()]


def talk(n, text="t"):
    return [(i, "user" if i % 2 == 0 else "assistant", f"{text}é{i}") for i in range(n)]


def rows():
    convs = {1: talk(3), 2: talk(7), 3: talk(7), 100: talk(9, "u"), 105: talk(2, "v"),
             4: [(0, None, "x"), (0, "x", None), (None, "user", "first"), (0, None, "x")],
             5: talk(40), 6: talk(39) + [(50, "user", "other")], 7: talk(17) + [(50, "a", "b")],
             None: talk(5) + [(9, "user", "last")], 305: talk(1), 12345: talk(6),
             8: [(0, "user", "")], 9: [(0, "use", "r")], 200: talk(1, "u")}
    return [(c, t, r, x, 1, 1, "a") for c, turns in convs.items() for t, r, x in turns]


@pytest.mark.parametrize("block, span", [(512, 4096), (8, 3), (2, 1)])
def test_nodes(worker_path, monkeypatch, block, span):
    monkeypatch.setattr(prefix_trie, "BLOCK_TURNS", block)
    monkeypatch.setattr(prefix_trie, "ID_RANGE", span)
    data = rows()
    df = worker_path.createDataFrame(data, SCHEMA).repartition(3)
    got, own = result(conversation_trie(df)), sequences([r[:4] for r in data])
    assert len(got) == len(set(got))
    assert set(got) == plain(own)
    convs = df.select(id_key("conv_id").alias("conv")).distinct()
    got = result(build_trie(rebuilt(turn_symbols(df), convs), convs))
    assert len(got) == len(set(got))
    assert set(got) == plain(begin_alike(own))


def test_empty_table(worker_path):
    assert conversation_trie(worker_path.createDataFrame([], SCHEMA)).collect() == []


def test_query_agrees_with_sql(worker_path):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS FROM read_parquet('{SF_SMALL}/conversations.parquet')")
    want = con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({TRIE_SQL})").fetchall()
    got = result(op13_prefix_trie(worker_path, SF_SMALL))
    assert sorted(got, key=str) == sorted(want, key=str)
