"""Driver contract: entry point, registry, and SQL twins on the smallest scale."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
from check_oracle import digest, norm  # noqa: E402

import __spark_entry__ as E
from tests.conftest import SF_SMALL

def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 6000
    assert "personal_cfar" in df.columns


def test_registry_shape():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    assert set(E.QUERIES) <= set(sql)


@pytest.mark.parametrize("name", ["rate_problem", "kc_count", "step_rollup", "renumber_rows",
                                  "problem_median", "duration_histogram", "rate_strict"])
def test_oracle_agrees_small(spark, name):
    con = duckdb.connect()
    for t in ("lineitem", "orders", "part", "events"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    ours = E.queries()[name](spark, SF_SMALL).toPandas()
    theirs = con.sql(E.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) == len(theirs)
    assert digest(norm(ours)) == digest(norm(theirs))
