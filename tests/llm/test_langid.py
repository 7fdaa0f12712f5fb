import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kcflow.llm.langid import BEGIN, END, cut_offs, fit, identify, words
from kcflow.llm.queries import held_out, op8_language_id
from tests.conftest import SF_SMALL
from tests.llm.conftest import DOC_SCHEMA, doc_rows


def invented(seed, syllables, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))


X, Y = "ka to mi ru sen".split(), "bla gru ost wen dä".split()


def documents(spark):
    docs = [(i, invented(i, X if i % 2 else Y, 60), "x" if i % 2 else "y") for i in range(60)]
    docs += [(100, invented(100, X, 200), None), (101, invented(101, Y, 5), None), (102, None, "x"),
             (103, "", "x"), (104, "12 ½ ² !!", "y"), (None, invented(7, X, 50), "x"),
             (105, "qqqq zzzz wwww vvvv jjjj " * 40, None), (106, "KA TO" * 30, "x"),
             (106, "KA TO" * 30, "x")]
    return spark.createDataFrame(doc_rows(docs), DOC_SCHEMA).repartition(3)


def test_languages_and_rejection(worker_path):
    rows = {r.row.doc_id: r for r in identify(documents(worker_path), ~held_out()).collect()}
    for i in range(60):
        assert rows[i].lang_pred == ("x" if i % 2 else "y") and not rows[i].rejected
        assert 0.9 < rows[i].score <= 1
    assert rows[100].lang_pred == "x" and rows[101].lang_pred == "y"
    assert not rows[100].rejected and not rows[101].rejected and not rows[None].rejected
    for i in (102, 103, 104):
        assert rows[i].lang_pred == "und" and rows[i].score == 0 and rows[i].rejected
    assert rows[105].rejected and rows[105].lang_pred in ("x", "y")


def test_model_is_a_distribution(worker_path):
    texts = [("x", invented(i, X, 30)) for i in range(20)] + [("y", invented(9, Y, 30))]
    model = fit(worker_path.createDataFrame(texts, "lang string, text string"))
    assert model.langs == ["x", "y"]
    alphabet = sorted({c for _, t in texts for c in t if c.isalpha()} | {END})
    for history in ("", "k", "ka", "ost", "zz"):
        # differences of word scores give the probability of each next character
        with_next = np.array([model.score([history + c if c != END else history])[0]
                              for c in alphabet])
        first = model.score([history])[0]
        for j in range(2):
            start = 0.0
            for k in range(len(history)):
                start += np.log(_next(model, history[:k], history[k], j))
            total = sum(_next(model, history, c, j) for c in alphabet)
            assert total == pytest.approx(1.0, abs=1e-6)
            assert first[j] == pytest.approx(start + np.log(_next(model, history, END, j)))
        assert with_next.shape == (len(alphabet), 2)


def _next(model, history, c, j):
    """p(c | history) by the recursion, from the tables."""
    from kcflow.llm.langid import hash_grams
    marked = BEGIN + history
    p = model.floor
    for k in range(1, model.order + 1):
        if len(marked) < k - 1:
            break
        context = marked[len(marked) - (k - 1):] if k > 1 else ""
        row = model.lookup(hash_grams([context + c]))[0]
        if k == 1:
            below = model.root[j]
        else:
            below = model.below[model.lookup(hash_grams([context]))[0], j]
        p = model.share[row, j] + below * p
    return p


def plain_scorer(rows, order):
    """Interpolated Kneser-Ney by its definition: log probability of a word in a language."""
    raw = defaultdict(Counter)
    for lang, text in rows:
        for w in words(text):
            marked = BEGIN + w + END
            for end in range(2, len(marked) + 1):
                for k in range(1, min(order, end) + 1):
                    raw[lang][marked[end - k:end]] += 1
    adjusted, discount, total, left = {}, {}, {}, {}
    for lang, own in raw.items():
        before = Counter(g[1:] for g in own if len(g) > 1)
        for g, n in own.items():
            whole = len(g) == order or g.startswith(BEGIN)
            adjusted[lang, g] = n if whole else before.get(g, 1)
        for k in range(1, order + 1):
            of = Counter(a for (x, g), a in adjusted.items() if x == lang and len(g) == k)
            discount[lang, k] = of[1] / (of[1] + 2 * of[2]) if of[1] else 0.5
    for (lang, g), a in adjusted.items():
        total[lang, g[:-1]] = total.get((lang, g[:-1]), 0) + a
    share = {(lang, g): max(a - discount[lang, len(g)], 0) / total[lang, g[:-1]]
             for (lang, g), a in adjusted.items()}
    for (lang, g), s in share.items():
        left[lang, g[:-1]] = left.get((lang, g[:-1]), 1.0) - s
    floor = 1 / len({g[-1] for _, g in adjusted})

    def score(lang, word):
        marked, out = BEGIN + word + END, 0.0
        for end in range(2, len(marked) + 1):
            p = floor
            for k in range(1, min(order, end) + 1):
                g = marked[end - k:end]
                p = share.get((lang, g), 0.0) + max(left.get((lang, g[:-1]), 1.0), 1e-9) * p
            out += np.log(p)
        return out

    return score


def test_scores_equal_plain_kneser_ney(worker_path):
    rows = [("x", invented(i, X, 40)) for i in range(8)] + [
        ("y", invented(i, Y, 25)) for i in range(5)] + [("z", "a"), ("z", None), ("z", "")]
    model = fit(worker_path.createDataFrame(rows, "lang string, text string").repartition(3))
    score = plain_scorer(rows, model.order)
    new = sorted(set(invented(99, X + Y, 60).split()) | {"a", "q", "dädä"})
    got = model.score(new)
    for i, w in enumerate(new):
        for j, lang in enumerate(model.langs):
            assert got[i, j] == pytest.approx(score(lang, w), abs=1e-9)


def test_a_rare_language_keeps_its_ngrams(worker_path):
    rng = random.Random(5)
    many = ["".join(rng.choices("abcdefghijklm", k=rng.randint(2, 7))) for _ in range(4000)]
    docs = [(i, " ".join(rng.choices(many, k=300)), "large") for i in range(60)]
    docs += [(100 + i, invented(i, Y, 12), "rare") for i in range(4)]
    docs += [(200 + i, invented(50 + i, Y, 12), None) for i in range(10)]
    df = worker_path.createDataFrame(doc_rows(docs), DOC_SCHEMA)
    known = F.col("lang").isNotNull()
    for bound in (1000, 5000, 10**6):
        rows = identify(df, known, max_grams=bound).where("row.doc_id >= 100").collect()
        assert {r.lang_pred for r in rows} == {"rare"}


def test_cut_offs():
    assert cut_offs({"a": (10, 5, 2), "b": (100, 40, 9)}, 1000) == {"a": 1, "b": 1}
    assert cut_offs({"a": (10, 5, 2), "b": (100, 40, 9)}, 60) == {"a": 1, "b": 2}
    assert cut_offs({"a": (10, 5, 2), "b": (100, 40, 9)}, 12) == {"a": 2, "b": 8}


@pytest.mark.parametrize("noise", [1, 5, 20])
def test_labelled_junk_does_not_teach_to_accept_it(worker_path, noise):
    def junk(seed):
        rng = random.Random(1000 + seed)
        return " ".join("".join(rng.choices("bcdfghjklmnpqrstvwxz", k=rng.randint(3, 9)))
                        for _ in range(40))

    docs = [(i, junk(i) if i % 100 < noise else invented(i, X if i % 2 else Y, 60),
             "x" if i % 2 else "y") for i in range(400)]
    docs += [(1000 + i, junk(5000 + i), None) for i in range(30)]
    rows = identify(worker_path.createDataFrame(doc_rows(docs), DOC_SCHEMA).repartition(4),
                    F.col("lang").isNotNull()).collect()
    good = [r for r in rows if r.row.doc_id < 400 and r.row.doc_id % 100 >= noise]
    assert not any(r.rejected for r in good)
    assert sum(r.rejected for r in rows if r.row.doc_id >= 1000) >= 29


def test_bound_on_the_model(worker_path):
    df = documents(worker_path)
    small = fit(df.where("lang IS NOT NULL").select("lang", "text"), max_grams=400)
    assert 0 < small.keys.size <= 800  # kept n-grams and their contexts
    rows = identify(df, ~held_out(), max_grams=400).where("row.doc_id < 60").collect()
    right = sum(r.lang_pred == r.row.lang for r in rows)
    assert right >= 57


def test_nothing_learned_and_empty(worker_path, none):
    rows = identify(documents(worker_path), F.lit(False)).collect()
    assert {(r.lang_pred, r.score, r.rejected) for r in rows} == {("und", 0.0, True)}
    assert identify(none, ~held_out()).collect() == []


def test_held_out_accuracy(worker_path):
    got = op8_language_id(worker_path, SF_SMALL).toPandas()
    docs = pd.read_parquet(f"{SF_SMALL}/documents.parquet", columns=["doc_id", "lang"])
    both = got.merge(docs, on="doc_id")
    assert len(got) == len(docs) and both.held_out.any()
    own = both[both.held_out & both.lang.notna()]
    assert (own.lang_pred == own.lang).mean() >= 0.97
