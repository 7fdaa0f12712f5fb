import duckdb
import pytest

import corpus_pipeline
from kcflow.llm.queries import DECONTAMINATION_SQL, JACCARD_SQL, LINE_DEDUP_SQL
from tests.conftest import SF_SMALL
from tests.llm.conftest import DOC_SCHEMA, after_all, doc_rows, edited, prose


@pytest.fixture(scope="module")
def results(worker_path, tmp_path_factory):
    """Every stage's input and output on the smallest tables."""
    docs = worker_path.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp(f"stage{k}") / "out")
        stage(worker_path, docs, SF_SMALL).write.parquet(path)
        after = worker_path.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def stage_sql(before, sql):
    con = duckdb.connect()
    con.register("documents", before.toPandas())
    con.sql(f"CREATE VIEW benchmark AS FROM read_parquet('{SF_SMALL}/benchmark.parquet')")
    return con.sql(sql).df()


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "jaccard_join", "decontamination", "packing"]


def test_columns(results):
    for name, (before, after) in results.items():
        if name != "packing":
            assert after.dtypes == before.dtypes


def test_language_id(results):
    before, after = results["language_id"]
    assert 0.98 * before.count() <= after.count() <= before.count()


def test_line_dedup(results):
    before, after = results["line_dedup"]
    want = stage_sql(before, LINE_DEDUP_SQL)
    got = after.selectExpr("doc_id", "sha2(coalesce(text, ''), 256) AS k", "n_chars",
                           "length(text) AS n").toPandas()
    assert dict(zip(got.doc_id, got.k)) == dict(zip(want.doc_id, want.kept_sha256))
    assert (got.n_chars == got.n).all()


def test_jaccard_join(results):
    before, after = results["jaccard_join"]
    want = stage_sql(before, JACCARD_SQL)
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(want.component_id))


def test_decontamination(results):
    before, after = results["decontamination"]
    leaks = set(stage_sql(before, DECONTAMINATION_SQL).doc_id)
    assert leaks
    assert {r.doc_id for r in after.collect()} == {
        r.doc_id for r in before.collect()} - leaks


def test_packing(results):
    before, after = results["packing"]
    assert {r.doc_id for r in after.select("doc_id").collect()} == {
        r.doc_id for r in before.select("doc_id").collect()}
    assert after.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= 1024


def test_odd_rows(odd):
    spark, docs, n = odd.sparkSession, odd, []
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SF_SMALL)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.dtypes == odd.dtypes, name
        n.append({after_all(r.doc_id) for r in docs.collect()})
    assert {30, 31, 32, 35} & n[0] == set()  # no letter
    assert n[0] >= {3, 4, 5, 9, 12, 20, 21, 40, 41, 42}
    assert {3, 12, 20} <= n[2] <= n[1] and n[3] == n[2]
    assert corpus_pipeline.STAGES[4][1](spark, docs, SF_SMALL).count() >= len(n[3])


def test_empty(none):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(none.sparkSession, none, SF_SMALL).collect() == []


def test_run(worker_path):
    rows = corpus_pipeline.run(worker_path, SF_SMALL)
    assert rows.count() > 0 and {"doc_id", "sequence_id", "offset", "ids"} <= set(rows.columns)


def test_rows_that_share_an_id(worker_path):
    """One row near another document, or contaminated, takes no other row without an id along."""
    one, clean, repeated = prose(800, 90, 90), prose(801, 90, 90), prose(802, 90, 90)
    item = next(r.text for r in worker_path.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
                if r.text and len(r.text.split()) >= 10)
    leak = f"{prose(803, 30, 30)} {item} {prose(804, 30, 30)}"
    docs = worker_path.createDataFrame(doc_rows([
        (1, one, "en"), (None, edited(one, 1, 1), "en"), (None, clean, "en"), (None, leak, "en"),
        (3, repeated, "en"), (3, leak + " x y", "en")]), DOC_SCHEMA).repartition(3)
    stages = dict(corpus_pipeline.STAGES)
    kept = {r.text for r in stages["jaccard_join"](worker_path, docs, SF_SMALL).collect()}
    assert {one, clean, repeated} <= kept and edited(one, 1, 1) not in kept
    left = stages["decontamination"](worker_path, docs, SF_SMALL).collect()
    assert {r.text for r in left} == {one, edited(one, 1, 1), clean, repeated}
