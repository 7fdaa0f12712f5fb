import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from kcflow.llm import mixing
from kcflow.llm.mixing import permuted, plan_mix, taken
from kcflow.llm.queries import op11_source_mixing
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes):
    """Targets of sources in order: share by weight, full ones leave the rest."""
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sizes)}
    left, open_, out = 1.5 * sum(sizes.values()), dict(sizes), {}
    while open_:
        per = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * per > 2 * open_[s]]
        if not full:
            return out | {s: weight[s] * per for s in open_}
        for s in full:
            out[s] = 2 * open_.pop(s)
            left -= out[s]
    return out


def judged(got, rows, slack):
    """Results against a plain count of the same rows (doc_id, source, text)."""
    sizes = {}
    for _, source, text in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    sizes = {s: sizes[s] for s in order}
    targets, sums = plain_targets(sizes), dict.fromkeys(sizes, 0)
    assert len(got) == len(rows)
    by_id = {}
    for i, source, text in rows:
        by_id.setdefault((i, len(WORD.findall(text or ""))), []).append(source)
    for r in got:
        source = by_id[r.doc_id, r["size"]].pop()
        assert r.source_size == sizes[source]
        assert r.target == pytest.approx(targets[source])
        assert 0 <= r.taken <= 2 * r["size"]
        sums[source] += r.taken
    for s in sizes:
        assert abs(sums[s] - targets[s]) <= slack, (s, sums[s], targets[s])


def test_permutation():
    for n in (1, 2, 3, 7, 64, 1000):
        for key in (0, -5, 12345):
            out = permuted(pd.Series(range(n)), pd.Series([n] * n), pd.Series([key] * n))
            assert sorted(out) == list(range(n))
    one, two = (list(permuted(pd.Series(range(50)), pd.Series([50] * 50), pd.Series([key] * 50)))
                for key in (1, 2))
    assert one != two


def odd_docs():
    rows = [(i, f"s{i % 7}", "wörd " * (i % 50)) for i in range(300)]
    rows += [(500 + i, "hot", f"a{i}\tb \x0bc\n" * 40) for i in range(150)]
    return rows + [(1000, None, "no source here " * 30), (None, "hot", "no id"), (1001, "", "x"),
                   (1002, "empty", None), (1003, "empty", " \n"), (1004, "long", "w " * 30000),
                   (1005, "twice", "same text " * 40), (1005, "twice", "same text " * 40)]


def test_odd_rows(worker_path, monkeypatch):
    rows = odd_docs()
    df = worker_path.createDataFrame(
        [(*r, 1, 1) for r in rows], "doc_id long, source string, text string, size long, rank long")
    judged(taken(plan_mix(df.repartition(3))).collect(), rows, 64)
    monkeypatch.setattr(mixing, "ROWS_PER_BLOCK", 20)
    mix = plan_mix(df.repartition(5), block_words=8, shard_slots=50)
    first = taken(mix).collect()
    judged(first, rows, 8)
    again = taken(plan_mix(df.repartition(2), block_words=8, shard_slots=50)).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))
    shards = mix.slots.groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("a"),
                                            F.max("slot").alias("b")).collect()
    assert all(s.n <= 50 and s.a == 0 and s.b == s.n - 1 for s in shards)
    # the texts hold the words that are counted, and blocks are whole but for a source's last
    texts = mix.texts(df).collect()
    assert len(texts) == mix.slots.count()
    assert sum(len(WORD.findall(r.text)) for r in texts) == sum(r.taken for r in first)
    assert all(len(WORD.findall(r.text)) <= 8 for r in texts)
    # every block comes once before any comes twice
    times = mix.slots.groupBy("rank", "block").count().join(
        mix.sources, "rank").select("rank", "blocks", "quota", "count").collect()
    by_rank = {}
    for r in times:
        by_rank.setdefault(r.rank, (r.blocks, r.quota, []))[2].append(r["count"])
    for blocks, quota, counts in by_rank.values():
        assert sum(counts) == quota and max(counts) <= 2
        assert max(counts) == 1 or len(counts) == blocks


def test_counts_vary_by_shard(worker_path):
    """Shards are draws, not equal shares."""
    df = worker_path.createDataFrame(
        [(i, f"s{i % 3}", "w " * 64) for i in range(600)], "doc_id long, source string, text string")
    mix = plan_mix(df, shard_slots=60)
    counts = [r["count"] for r in mix.slots.where("rank = 0").groupBy("shard").count().collect()]
    assert len(set(counts)) > 2


def test_empty_tables(worker_path):
    schema = "doc_id long, source string, text string"
    assert taken(plan_mix(worker_path.createDataFrame([], schema))).collect() == []
    got = taken(plan_mix(worker_path.createDataFrame([(1, "a", " "), (2, None, None)], schema)))
    assert sorted(map(tuple, got.collect())) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_query(worker_path):
    import pyarrow.parquet as pq
    rows = [(r["doc_id"], r["source"], r["text"]) for r in
            pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()]
    judged(op11_source_mixing(worker_path, SF_SMALL).collect(), rows, 64)
