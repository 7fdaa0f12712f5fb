from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from kcflow.llm import suffix_dedup
from kcflow.llm.suffix_dedup import dedup_substrings
from kcflow.llm.suffix_sort import common_prefixes, suffix_array, words_at
from tests.llm.conftest import DOC_SCHEMA, after_all, doc_rows, prose


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.binary(max_size=150), st.text("ab", max_size=200).map(str.encode),
                 st.text("abc", min_size=1, max_size=9).map(lambda s: s.encode() * 20)))
def test_suffix_array(data):
    text = np.frombuffer(data, np.uint8)
    words = words_at(text)
    order = suffix_array(text, words)
    assert sorted(order.tolist()) == list(range(len(data)))
    suffixes = [data[i:i + 50] for i in order]
    assert suffixes == sorted(suffixes)
    padded = data + bytes(100)
    for (i, j), shared in zip(zip(order[1:], order[:-1]), common_prefixes(order, words)[1:]):
        a, b = padded[i:i + 56], padded[j:j + 56]
        assert shared == next((k for k in range(56) if a[k] != b[k]), 56)


def plain(rows):
    texts = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in texts:
        for p in range(len(b) - 49):
            w = b[p:p + 50]
            first[w] = min(first.get(w, after_all(i)), after_all(i))
    out = Counter()
    for i, b in texts:
        away = [False] * len(b)
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < after_all(i):
                away[p:p + 50] = [True] * 50
        spans = sum(x and not y for x, y in zip(away, [False, *away[:-1]]))
        out[(i, bytes(c for c, x in zip(b, away) if not x), len(b), sum(away), spans)] += 1
    return out


def result(df):
    return Counter((r.row.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans)
                   for r in df.collect())


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_odd_rows(odd, odd_rows):
    assert result(dedup_substrings(odd)) == plain(odd_rows)


def test_split_anchors(worker_path, monkeypatch):
    """Windows by themselves, small sorting blocks, texts in several parts."""
    passage = prose(8, 30)
    docs = [(i, prose(100 + i, 40) + passage[i % 7:] + prose(200 + i, 20), "en")
            for i in range(12)]
    df = worker_path.createDataFrame(doc_rows(docs), DOC_SCHEMA).repartition(4)
    want = plain(rows_of(df))
    assert result(dedup_substrings(df)) == want
    monkeypatch.setattr(suffix_dedup, "SPLIT_ABOVE", 2)
    assert result(dedup_substrings(df)) == want


def test_texts_in_parts(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HASH_BYTES", 256)
    texts = [prose(1, 200).encode(), b"", prose(2, 3).encode(), prose(1, 200).encode()]
    seen = {}
    for row, body, starts, ends, offset in suffix_dedup._pieces(texts):
        found = suffix_dedup.Anchors(np.frombuffer(body, np.uint8), starts, ends)
        for d, k, a, b in zip(found.doc, found.key, found.first, found.last):
            for w in range(a, b + 1):
                at = w - starts[d] + offset[d]
                assert texts[row[d]][at:at + 50] == body[w:w + 50]
                seen.setdefault(int(row[d]), {})[int(at)] = int(k)
    assert set(seen[0]) == set(range(len(texts[0]) - 49))
    assert seen[0] == seen[3]


def test_empty_table(none):
    assert dedup_substrings(none).collect() == []
