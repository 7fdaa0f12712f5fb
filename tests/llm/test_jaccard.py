import duckdb
import numpy as np
import pytest

from kcflow.llm import jaccard_join
from kcflow.llm.graph import components
from kcflow.llm.jaccard_join import overlap_bound, signature, similar_groups
from kcflow.llm.queries import JACCARD_SQL, op4_jaccard_join
from tests.conftest import SF_SMALL
from tests.llm.conftest import DOC_SCHEMA, after_all, doc_rows, edited, prose


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def plain(rows):
    """{(id, set size): component}; ids with different texts do not occur here."""
    sets = {after_all(i): shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            x, y = sets[a], sets[b]
            if a < b and x and y and 100 * len(x & y) >= 75 * len(x | y):
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    return {(i, len(s), root(i)) for i, s in sets.items()}


def result(df):
    return {(r.d, r.n_shingles, r.component) for r in df.collect()}


def groups(worker_path):
    """Near copies in long chains, different sizes, and shared passages."""
    docs, n = [], 0
    for k in range(6):
        text = prose(k, 60 + 20 * k, 1000)
        for step in range(9):
            docs.append((n * 7 % 101, text, "en"))
            n += 1
            text = edited(text, n, 1)
        docs.append((1000 + k, prose(99, 40, 1000) + " " + prose(50 + k, 50, 1000), "en"))
    return worker_path.createDataFrame(doc_rows(docs), DOC_SCHEMA).repartition(4)


def test_odd_rows(odd, odd_rows):
    df = similar_groups(odd)
    assert df.count() == odd.count()
    assert result(df) == plain(odd_rows)


@pytest.mark.parametrize("tile_rows", [20_000, 2])
def test_chains_and_tiles(worker_path, monkeypatch, tile_rows):
    monkeypatch.setattr(jaccard_join, "TILE_ROWS", tile_rows)
    docs = groups(worker_path)
    assert result(similar_groups(docs)) == plain(
        [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_tiles_alone_find_all_links(worker_path, monkeypatch):
    """Without the first comparison of neighbours, everything comes from the tiles."""
    docs = groups(worker_path)
    real = jaccard_join.linked
    calls = []

    def first_none(pairs, texts, percent):
        calls.append(1)
        return real(pairs.limit(0) if len(calls) == 1 else pairs, texts, percent)

    monkeypatch.setattr(jaccard_join, "linked", first_none)
    monkeypatch.setattr(jaccard_join, "_pairs", _all_pairs(jaccard_join._pairs))
    monkeypatch.setattr(jaccard_join, "TILE_ROWS", 3)
    assert result(similar_groups(docs)) == plain(
        [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def _all_pairs(real):
    calls = []

    def pairs(edges):
        calls.append(1)
        return real(edges).limit(0) if len(calls) == 1 else real(edges)
    return pairs


def test_bound_never_below_overlap():
    rng = np.random.default_rng(1)
    for _ in range(200):
        pool = np.unique(rng.integers(0, 2**63, rng.integers(2, 900)).astype(np.uint64))
        a = np.sort(rng.choice(pool, rng.integers(1, pool.size + 1), replace=False))
        b = np.sort(rng.choice(pool, rng.integers(1, pool.size + 1), replace=False))
        shared = np.intersect1d(a, b).size
        assert overlap_bound(signature(a), signature(b), a.size, b.size) >= shared
        assert overlap_bound(signature(a), signature(a), a.size, a.size) == a.size


def test_components(worker_path):
    edges = [(i, i + 1) for i in range(40)] + [(100, 205), (205, 150), (7, 7)]
    df = worker_path.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in components(df).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 100, 150: 100, 205: 100}
    assert components(df.limit(0)).collect() == []


def test_empty_table(none):
    assert similar_groups(none).collect() == []


def test_query_agrees_with_sql(worker_path):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM read_parquet('{SF_SMALL}/documents.parquet')")
    want = con.sql(f"SELECT doc_id, n_shingles, component_id FROM ({JACCARD_SQL})").fetchall()
    assert {tuple(r) for r in op4_jaccard_join(worker_path, SF_SMALL).collect()} == set(want)


@pytest.mark.parametrize("last", [60, 2**63 - 2, None])
def test_rows_without_an_id_of_their_own(worker_path, last):
    """Null and repeated ids: each text is a node; `last` leaves no room above or at all."""
    one, two, three, four = (prose(700 + k, 80, 80) for k in range(4))
    docs = [(1, one), (None, edited(one, 1, 1)), (None, two), (None, three), (None, three),
            (5, edited(four, 2, 1)), (5, edited(two, 3, 1)), (7, four),
            (2**63 - 2 if last is None else last, prose(710, 80, 80))]
    docs += [(-2**63, prose(711, 80, 80))] if last is None else []
    df = worker_path.createDataFrame(
        doc_rows([(i, t, "en") for i, t in docs]), DOC_SCHEMA).repartition(3)
    rows = similar_groups(df).collect()
    assert len(rows) == len(docs)
    got = {(r.row.doc_id, r.row.text): r.component for r in rows}
    want = [1, 1, 5, 2**63 - 1, 2**63 - 1, 5, 5, 5, *(i for i, _ in docs[8:])]
    assert got == {k: c for k, c in zip(docs, want, strict=True)}
    assert {r.row.text for r in rows if (r.d, r.v) == (r.component, r.component_v)} == {
        one, three, docs[5][1], docs[6][1], *(t for _, t in docs[8:])}
