import duckdb
from collections import Counter

from kcflow.llm import bloom
from kcflow.llm.line_dedup import dedup_lines
from kcflow.llm.queries import LINE_DEDUP_SQL, op1_line_dedup
from tests.conftest import SF_SMALL
from tests.llm.conftest import after_all

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def plain(rows):
    where = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                where.setdefault(key(line), set()).add(after_all(i))
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(where.get(key(x), ())) < 2
                or after_all(i) == min(where[key(x)])]
        out[(i, None if t is None else "\n".join(kept), len(lines), len(lines) - len(kept))] += 1
    return out


def result(df):
    return Counter((r.row.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect())


def test_odd_rows(odd, odd_rows):
    assert result(dedup_lines(odd)) == plain(odd_rows)


def test_full_filters_change_nothing(odd, odd_rows, monkeypatch):
    monkeypatch.setattr(bloom, "MIN_BITS", 2**9)
    monkeypatch.setattr(bloom, "MAX_BITS", 2**9)
    assert result(dedup_lines(odd)) == plain(odd_rows)


def test_empty_table(none):
    assert dedup_lines(none).collect() == []


def test_query_agrees_with_sql(worker_path):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM read_parquet('{SF_SMALL}/documents.parquet')")
    want = con.sql(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({LINE_DEDUP_SQL})")
    got = op1_line_dedup(worker_path, SF_SMALL)
    assert {tuple(r) for r in got.collect()} == set(want.fetchall())


def test_python_gets_few_texts_at_once(spark, monkeypatch, tmp_path):
    """Whole texts of a long partition go to Python in small batches, and the cleaned
    texts are not made there at all."""
    from kcflow.llm import line_dedup
    from kcflow.llm.common import BATCH_ROWS

    seen = []
    taken = line_dedup.twice_filter

    def at(hashes, source, bits):
        seen.append(int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")))
        return taken(hashes, source, bits)

    monkeypatch.setattr(line_dedup, "twice_filter", at)
    rows = [(i, f"a line of many documents\nown line {i} of {i}\n") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    out = dedup_lines(docs)
    assert seen and max(seen) <= BATCH_ROWS
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "pythonUDF" not in plan and "cleaned" not in plan
    assert result(out) == plain(rows)
