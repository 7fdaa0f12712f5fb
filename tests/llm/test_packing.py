import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kcflow.llm import numbering, packing
from kcflow.llm.packing import pack, places, plan
from kcflow.llm.tokens import Encoder

P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(" \n\tab'é1.<|>", max_size=60),
                 st.text("the end <|endoftext|> 's　\u0085 ", max_size=60),
                 st.lists(st.sampled_from(["<|endoftext|>", " ", "a", "<|endoftext", "|>", "é\n"]),
                          max_size=9).map("".join)))
def test_same_ids(text):
    t = Tokenizer.from_file(PATH) if not hasattr(test_same_ids, "t") else test_same_ids.t
    test_same_ids.t = t
    assert Encoder.at(PATH).encode(text).tolist() == t.encode(text, add_special_tokens=False).ids


def test_added_token_in_a_text():
    assert Encoder.at(PATH).encode("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=40))
def test_plan(counts):
    layouts = plan(counts, 64)
    used = {}
    for layout, n in layouts:
        assert n > 0 and 0 < sum(layout) <= 64
        assert sum(3 * s > 64 for s in layout) <= 2
        for s in layout:
            used[s] = used.get(s, 0) + n
    assert used == counts
    bins, total = sum(n for _, n in layouts), sum(s * c for s, c in counts.items())
    assert bins <= max(1.7 * total / 64 + 1, sum(c for s, c in counts.items() if 2 * s > 64) + 1
                       + total / 64)
    spot = places(layouts)
    for s, rows in spot.items():
        assert rows[0, 0] == 0 and (np.diff(rows[:, 0]) > 0).all()


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(2)
    sizes = np.clip(rng.lognormal(5.5, 1.1, 20000).astype(int), 1, 1024)
    counts = dict(zip(*map(np.ndarray.tolist, np.unique(sizes, return_counts=True))))
    bins = sum(n for _, n in plan(counts, 1024))
    assert bins <= 1.01 * -(-sizes.sum() // 1024)


def test_pieces(odd, reference, monkeypatch):
    monkeypatch.setattr(numbering, "ROWS_PER_BLOCK", 4)
    monkeypatch.setattr(packing, "MOST_ROWS", 5)
    rows = pack(odd, PATH, ids=True).collect()
    want = sorted(tuple(reference.encode(t or "", add_special_tokens=False).ids + [2])
                  for _, t in [(r.doc_id, r.text) for r in odd.collect()])
    # repeated rows have equal pieces, so documents are compared as a sorted list
    by_doc = {}
    for r in rows:
        assert 0 < r.length == len(r.ids) <= 1024
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert r.piece == 0 or r.length == 1024
        by_doc.setdefault(r.doc_id, []).append(r)
    got = []
    for own in by_doc.values():
        copies = sum(r.piece == 0 for r in own)
        own = sorted(own, key=lambda r: r.start)
        got += [tuple(x for r in own[k::copies] for x in r.ids) for k in range(copies)]
    assert sorted(got) == want
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by_sequence.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 1024


def test_token_ids_are_not_numbered_with_their_pieces(odd, monkeypatch):
    """A block of full pieces would otherwise sort all of their ids in one task."""
    seen = []

    def numbered(df, *args, **kw):
        seen.extend(df.columns)
        return numbering.gapless(df, *args, **kw)

    monkeypatch.setattr(packing, "gapless", numbered)
    plain = {tuple(r) for r in pack(odd, PATH).collect()}
    rows = pack(odd, PATH, ids=True).collect()
    assert "length" in seen and "ids" not in seen
    # whole documents repeat, so each piece must meet its own ids once
    assert len(rows) == pack(odd, PATH).count() and {tuple(r)[:-1] for r in rows} == plain


def test_empty_table(none):
    assert pack(none, PATH).collect() == []
    assert pack(none, PATH, ids=True).collect() == []
