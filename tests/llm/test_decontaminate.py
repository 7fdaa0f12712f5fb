from collections import Counter

import duckdb

from kcflow.llm import decontaminate
from kcflow.llm.decontaminate import contaminated
from kcflow.llm.queries import DECONTAMINATION_SQL, op2_decontamination
from tests.conftest import SF_SMALL
from tests.llm.conftest import DOC_SCHEMA, doc_rows, edited, prose

ITEMS = [(1, prose(500, 40, 40)), (2, prose(501, 20, 20)), (3, "only three words"), (4, None),
         (5, ""), (None, prose(502, 30, 30)), (7, prose(500, 40, 40).upper())]


def found(docs, items):
    df = docs.sparkSession.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in contaminated(docs, df).collect()}


def sample(spark):
    passage = ITEMS[0][1]
    docs = [(1, prose(1, 50) + "\n" + passage + " " + prose(2, 50), "en"),
            (2, prose(3, 100), "en"),
            (3, edited(passage, 4, 1) + " " + prose(5, 10), "en"),
            (4, prose(6, 20) + " " + edited(passage, 7, 12) + " " + prose(8, 20), "en"),
            (5, "x ONLY  three\nwords y", "en"), (6, None, "en"), (7, "", None),
            (8, " ".join(passage.split(" ")[:35]), "en"),
            (None, ITEMS[5][1] + " " + ITEMS[1][1], "en"),
            (9, " ".join([prose(9, 4000), ITEMS[1][1], prose(10, 4000)]), "en"),
            (9, " ".join([prose(9, 4000), ITEMS[1][1], prose(10, 4000)]), "en")]
    return spark.createDataFrame(doc_rows(docs), DOC_SCHEMA).repartition(3)


EXPECTED = {(1, 1), (1, 7), (3, 1), (3, 7), (5, 3), (8, 1), (8, 7), (None, None), (None, 2),
            (9, 2)}


def test_planted(worker_path, monkeypatch):
    docs = sample(worker_path)
    rows = found(docs, ITEMS)
    assert set(rows) == EXPECTED
    exact = rows[1, 1]
    assert (exact.start, exact.n_words, exact.distance, exact.similarity) == (50, 40, 0, 1.0)
    assert 0.75 <= rows[3, 1].similarity < 1
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST", 0)  # the shuffled join
    assert set(found(docs, ITEMS)) == EXPECTED


def test_empty_tables(none, worker_path):
    assert found(none, ITEMS) == {}
    assert found(sample(worker_path), []) == {}


def test_fingerprints(worker_path):
    rows = [(1, h) for h in (0b1011, 0b0011, -1)] + [(2, -(2**63)), (2, -(2**63)), (2, 5)]
    df = worker_path.createDataFrame(rows, "k long, h long")
    marks = {r.k: r.mark for r in decontaminate.fingerprints(df, ["k"]).collect()}
    assert marks == {1: 0b1011, 2: -(2**63)}


def test_query_agrees_with_sql(worker_path):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    cols = "doc_id, item_id, start, round(similarity, 5)"
    want = set(con.sql(f"SELECT {cols} FROM ({DECONTAMINATION_SQL})").fetchall())
    got = op2_decontamination(worker_path, SF_SMALL)
    assert {(r.doc_id, r.item_id, r.start, round(r.similarity, 5)) for r in got.collect()} == want


def best_of_all_windows(text, item):
    """(similarity, start) of the best window among all starts, counted plainly."""
    w, v = text.lower().split(), item.lower().split()
    k = min(len(v), decontaminate.SHINGLE)

    def bag(x):
        return Counter(tuple(x[i:i + k]) for i in range(len(x) - k + 1))

    scores = {}
    for s in range(max(0, len(w) - len(v)) + 1):
        a, b = bag(w[s:s + len(v)]), bag(v)
        scores[s] = (a & b).total() / (a | b).total()
    return max(scores.values()), scores


def test_all_windows(worker_path):
    one, two = prose(600, 20, 20), prose(601, 20, 20)
    again = " ".join(["a b c d e f"] * 6 + [prose(602, 10, 10)])
    items = [(1, f"{one} {two}"), (2, again), (3, prose(603, 12, 12))]
    moved = " ".join(items[2][1].split()[6:] + items[2][1].split()[:6])
    texts = [f"{prose(610, 60, 60)} {two} {one} {prose(611, 60, 60)}",
             f"{two} {one}", f"{prose(612, 30, 30)} {one} x y {two} {prose(613, 9, 9)}",
             " ".join(["z a b c d e f a b c d"] * 3 + [again, "b c d e f a"] * 2),
             " ".join(["a b c d e f"] * 40), f"u v {moved} w {items[2][1]}",
             edited(items[0][1], 614, 3) + " " + edited(items[0][1], 615, 1)]
    docs = worker_path.createDataFrame(
        doc_rows([(i, t, "en") for i, t in enumerate(texts)]), DOC_SCHEMA)
    rows, want = found(docs, items), set()
    for i, t in enumerate(texts):
        for j, item in items:
            best, scores = best_of_all_windows(t, item)
            if best >= 0.75:
                want.add((i, j))
                assert abs(rows[i, j].similarity - best) < 1e-9
                assert abs(scores[rows[i, j].start] - best) < 1e-9
    assert set(rows) == want and (0, 1) in want
    assert rows[0, 1].start == 60  # no shared shingle has its place in the item here


def test_very_long_item(worker_path):
    """More than 2^16 words: the counters of a fingerprint hold them."""
    item = prose(77, 70000, 70000)
    docs = worker_path.createDataFrame(
        doc_rows([(1, "before " + item + " after", "en"), (2, prose(78, 300), "en")]), DOC_SCHEMA)
    rows = found(docs, [(1, item)])
    assert set(rows) == {(1, 1)} and rows[1, 1].similarity == 1.0 and rows[1, 1].start == 1
