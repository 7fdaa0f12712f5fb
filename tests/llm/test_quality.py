import random
import re
from collections import Counter

import pytest

from kcflow.llm.quality import BANDS, judge_quality, repeated_words
from tests.llm.conftest import DOC_SCHEMA, doc_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    t = text or ""
    words = WORD.findall(t)
    seen = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if seen[tuple(words[i:i + 8])] > 1
              for j in range(i, i + 8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(inside), failed)


def test_odd_rows(odd, odd_rows):
    rows = judge_quality(odd).collect()
    got = Counter((r.row.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                   r.n_repeat_words, r.base_failed) for r in rows)
    assert got == Counter((i, *plain(t)) for i, t in odd_rows)
    assert not any(r.kept and r.base_failed for r in rows)


def test_repeated_words():
    rng = random.Random(3)
    for _ in range(60):
        texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) for _ in range(4)]
        want = [plain(t)[4] for t in texts]
        assert repeated_words([t.encode().split() for t in texts]).tolist() == want


@pytest.mark.parametrize("n", [40, 200, 1500])
def test_bands(worker_path, n):
    rng = random.Random(n)
    noise = " ".join("".join(chr(rng.randint(0x21, 0x24FF)) for _ in range(5)) for _ in range(n))
    few = " ".join(f"w{i % 7}{'x' * (i // 7 % 3)}{i // 21 % 40}" for i in range(n))
    docs = [(1, prose(n, n), "en"), (2, noise, "en"),
            (3, " ".join(w for w in prose(1, n // 8).split() for _ in range(8)), "en"), (4, few, "en")]
    df = worker_path.createDataFrame(doc_rows(docs), DOC_SCHEMA)
    kept = {r.row.doc_id: r.kept for r in judge_quality(df).collect()}
    assert kept[1] and not kept[2] and not kept[3]


def test_bands_are_ordered():
    assert [b[0] for b in BANDS] == sorted(b[0] for b in BANDS)
    assert all(lo < hi for _, lo, hi in BANDS)


def test_empty_table(none):
    assert judge_quality(none).collect() == []
