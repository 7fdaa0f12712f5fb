import zlib
from collections import Counter

import xxhash

from kcflow.llm import numbering
from kcflow.llm.sharding import assign_shards, write_shards


def jump_by_step(doc_id, shards):
    """One random number per step; steps after the last shard change nothing."""
    seed = 42 if doc_id is None else xxhash.xxh64_intdigest(
        doc_id.to_bytes(8, "little", signed=True), 42)
    b, j = -1, 0
    for i in range(shards):
        if j >= shards:
            break
        bits = xxhash.xxh64_intdigest(i.to_bytes(8, "little", signed=True), seed) >> 33
        b, j = j, int((j + 1) * 2.0**31 / (bits + 1))
    return b


def test_places(odd, monkeypatch):
    monkeypatch.setattr(numbering, "ROWS_PER_BLOCK", 3)
    rows = assign_shards(odd, 4).collect()
    assert len(rows) == odd.count()
    texts = Counter((r.doc_id, len((r.text or "").encode()) + 8,
                     zlib.crc32((r.text or "").encode())) for r in odd.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == texts
    for r in rows:
        assert r.shard == jump_by_step(r.doc_id, 4)
        assert r.grown_shard in (r.shard, 4) and r.grown_shard == jump_by_step(r.doc_id, 5)
    for shard in {r.shard for r in rows}:
        own = sorted(r.slot for r in rows if r.shard == shard)
        assert own == list(range(len(own)))


def test_even_and_gapless_over_blocks(worker_path):
    docs = worker_path.range(20000).withColumnRenamed("id", "doc_id").selectExpr(
        "doc_id", "'t' AS text")
    rows = numbering.gapless(assign_shards(docs, 24).drop("slot"), ["shard"], ["doc_id"], "slot",
                             rows_per_block=500).collect()
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) == set(range(24))
    assert max(sizes.values()) < 1.25 * 20000 / 24
    moved = sum(r.grown_shard != r.shard for r in rows)
    assert 0.7 < moved / (20000 / 25) < 1.3
    for shard, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))


def test_empty_and_files(none, odd, tmp_path):
    assert assign_shards(none, 24).collect() == []
    write_shards(odd.withColumnRenamed("row", "shard"), str(tmp_path / "out"), 3)
    back = odd.sparkSession.read.parquet(str(tmp_path / "out"))
    assert back.count() == odd.count() and "_shard" in back.columns
