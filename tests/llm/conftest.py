import random

import pytest
from pyspark.sql import functions as F

SYLLABLES = "an er in on th re nd ti en at ed or es ha he st ou ly ea sh".split()


def prose(seed: int, n: int, line: int = 12) -> str:
    """n invented words, always the same for a seed."""
    rng = random.Random(seed)
    words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]
    return "\n".join(" ".join(words[i:i + line]) for i in range(0, n, line))


def edited(text: str, seed: int, n: int) -> str:
    """The text with n words changed."""
    rng, words = random.Random(seed), text.split(" ")
    for i in rng.sample(range(len(words)), n):
        words[i] = f"changed{seed}"
    return " ".join(words)


DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
              "row string, d long, v long, key long, n long, first long, version long")


def doc_rows(docs):
    """(doc_id, text, lang) with columns whose names the operators use inside."""
    return [(i, t, lang, "src", None if t is None else len(t), "x", 7, 7, 7, 7, 7, 7)
            for i, t, lang in docs]


@pytest.fixture(scope="session")
def worker_path(spark):
    from kcflow.session import ensure_worker_path
    ensure_worker_path(spark)
    return spark


@pytest.fixture(scope="session")
def odd(worker_path):
    """Nulls, empty and very long texts, ties, copies, near copies, repeated rows."""
    base, other = prose(1, 240), prose(2, 150)
    shared = prose(3, 70, 70)
    docs = [(5, base, "en"), (9, base, "en"), (3, edited(base, 1, 3), "en"),
            (4, edited(base, 2, 3), None), (12, edited(base, 3, 80), "en"),
            (20, other + "\n" + shared, "en"), (21, shared + "\n" + prose(4, 90), "en"),
            (22, shared.upper() + " tail", "de"), (30, None, "en"), (31, "", "en"),
            (32, " \n\t\n\r ", None), (33, "one two", "en"), (34, "One  TWO", "en"),
            (35, "12 34 !!", "en"), (None, other, "en"), (40, other, "en"),
            (41, prose(5, 30000), "en"), (42, "ein Wort äöü " * 40, "de"),
            (42, "ein Wort äöü " * 40, "de"), (43, "a" * 400, "en"),
            (44, "a" * 300, "en"), (45, "é" * 120, None), (46, "xé" + "é" * 90, None)]
    return worker_path.createDataFrame(doc_rows(docs), DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(worker_path):
    return worker_path.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def odd_rows(odd):
    return [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]


def after_all(doc_id):
    """A null id ranks after all others."""
    return 2**63 - 1 if doc_id is None else doc_id


def sha(data: bytes) -> str:
    import hashlib
    return hashlib.sha256(data).hexdigest()


__all__ = ["F"]
