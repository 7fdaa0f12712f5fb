"""A hot key holding a third of the rows: the sliced numbering must give the
same numbers as the window and as a brute-force count."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kcflow.operators.sequence import exact_quantiles, running_index, sliced
from kcflow.sources.fixtures import ITEM_KEYS, step_log
from tests.conftest import SF_SMALL

ORDER = ["first_tx", *ITEM_KEYS]


def test_hot_student_problem_view(spark):
    sl = step_log(spark, SF_SMALL, with_view=False, keep_keys=True)
    # every third line item goes to one student and one problem
    hot = sl.withColumns({
        "student": F.when(F.col("l_linenumber") % 3 == 0, F.lit("HOT")).otherwise(F.col("student")),
        "problem": F.when(F.col("l_linenumber") % 3 == 0, F.lit("P-HOT")).otherwise(F.col("problem"))})
    n_hot = hot.where("student = 'HOT'").count()
    assert n_hot > hot.count() / 4
    win = hot.withColumn("pv", F.row_number().over(
        Window.partitionBy("student", "problem").orderBy(*ORDER)))
    numbered = running_index(hot, ["student", "problem"], ORDER, "pv", num_partitions=9)
    key = [*ITEM_KEYS]
    a = {tuple(r[k] for k in key): r["pv"] for r in win.collect()}
    b = {tuple(r[k] for k in key): r["pv"] for r in numbered.collect()}
    assert a == b
    # brute force on the hot group
    pdf = hot.where("student = 'HOT'").toPandas().sort_values(ORDER)
    hot_b = [b[tuple(r[k] for k in key)] for _, r in pdf.iterrows()]
    assert hot_b == list(range(1, n_hot + 1))


def test_step_log_matches_duckdb(spark):
    """row and problem_view equal DuckDB's window functions."""
    import duckdb

    from kcflow.plans.oracle import with_steps
    from kcflow.sources.fixtures import build_step_log

    ours = build_step_log(spark, SF_SMALL).select(
        "split", "row", "problem_view", *ITEM_KEYS).toPandas()
    con = duckdb.connect()
    for t in ("lineitem", "orders", "part"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    theirs = con.sql(with_steps(
        "SELECT split, row, problem_view, " + ", ".join(ITEM_KEYS) + " FROM step_log")).df()
    key = ["split", *ITEM_KEYS]
    a = ours.sort_values(key).reset_index(drop=True)
    b = theirs.sort_values(key).reset_index(drop=True)
    assert len(a) == len(b) == 6000
    assert (a["row"].to_numpy() == b["row"].to_numpy()).all()
    assert (a["problem_view"].to_numpy() == b["problem_view"].to_numpy()).all()


def test_hot_value_is_one_row(spark):
    """A third of the rows at one value: quantiles are exact, and no slice of
    the sorted table has more than twice the mean."""
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0.5)).otherwise(F.col("id") / 7.0).alias("x"))
    got = exact_quantiles(df, "x", [0.25, 0.5, 0.9], names=["a", "b", "c"]).first()
    want = df.toPandas()["x"].quantile([0.25, 0.5, 0.9]).tolist()
    assert list(got) == pytest.approx(want)
    counts = df.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    sizes = [r["count"] for r in sliced(counts, [F.col("x")], 8).groupBy("_kc_pid").count().collect()]
    assert max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_changed_inputs_are_prepared_again(spark, tmp_path):
    import shutil

    for t in ("lineitem", "orders", "part"):
        (tmp_path / f"{t}.parquet").mkdir()
        shutil.copy(f"{SF_SMALL}/{t}.parquet", tmp_path / f"{t}.parquet" / "a.parquet")
    folder = str(tmp_path)
    assert step_log(spark, folder).count() == 6000
    shutil.copy(f"{SF_SMALL}/lineitem.parquet", tmp_path / "lineitem.parquet" / "b.parquet")
    assert step_log(spark, folder).count() == 12000


def test_scratch_tables_can_be_released(spark):
    from kcflow.session import ensure_checkpoint_dir, file_exists, release_scratch
    from kcflow.operators.sequence import materialize

    df = materialize(spark.range(5), "released")
    path = df.inputFiles()[0].rsplit("/", 1)[0]
    assert df.count() == 5 and file_exists(spark, path)
    release_scratch(spark)
    assert not file_exists(spark, path) and file_exists(spark, ensure_checkpoint_dir(spark))


def test_step_log_numbers_narrow_rows(spark, monkeypatch):
    """Columns that a record only asks about, and texts it joins, are not moved by a numbering."""
    from kcflow.sources import fixtures

    seen = []

    def numbered(df, groups, *args, **kw):
        seen.append(df.columns)
        assert groups[0] != "o_custkey"  # rows of a part, with its texts, lie together
        return running_index(df, groups, *args, **kw)

    monkeypatch.setattr(fixtures, "running_index", numbered)
    log = fixtures.build_step_log(spark, SF_SMALL)
    assert len(seen) == 2 and log.count() > 0
    wide = {"p_name", "p_brand", "p_type", "l_tax", "l_discount", "l_linestatus", "o_orderstatus"}
    assert not any(wide & set(columns) for columns in seen)


def test_flags_of_the_step_log_keep_nulls(spark, tmp_path):
    """A null tax, discount or status is neither: no start, two KCs, a known label."""
    from kcflow.sources.fixtures import build_step_log

    day = "timestamp_ntz'2020-01-02 00:00:00'"
    spark.sql(f"""SELECT 1L AS l_orderkey, 7L AS l_partkey, 3L AS l_suppkey, n AS l_linenumber,
        5D AS l_quantity, 2000D AS l_extendedprice, discount AS l_discount, tax AS l_tax,
        status AS l_linestatus, {day} AS l_shipdate
        FROM VALUES (1, 0.01D, 0.1D, 'F'), (2, null, 0.1D, null), (3, 0.01D, null, 'O'),
                    (4, 0.01D, 0D, 'O') AS t(n, discount, tax, status)""").write.parquet(
                        f"{tmp_path}/lineitem.parquet")
    spark.sql(f"SELECT 1L AS o_orderkey, 2L AS o_custkey, 'P' AS o_orderstatus, {day} AS "
              "o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("SELECT 7L AS p_partkey, 'red old' AS p_name, null AS p_brand, 'tin' AS p_type, "
              "4 AS p_size").selectExpr("* except (p_brand)", "cast(p_brand as string) p_brand") \
        .write.parquet(f"{tmp_path}/part.parquet")
    rows = build_step_log(spark, str(tmp_path)).orderBy("l_linenumber").collect()
    got = [(r.row, r.problem_view, r.hierarchy, r.kc, r.opportunity, r.cfa, r.dur) for r in rows]
    assert got == [(1, 1, "tin", "red", "5", None, 2.0), (2, 2, "tin", "red~~old", "5~~2", 1, 2.0),
                   (3, 3, "tin", "red", "5", 1, None), (4, 4, "tin", None, None, 1, None)]


def test_renumbering_queries_write_what_they_return(spark, monkeypatch):
    """The keys of the order, and other columns of the log, are not in the written slices."""
    from kcflow.operators import sequence
    from kcflow.plans.catalog import dataset

    seen = []

    def written(df, *args, **kw):
        seen.append(set(df.columns))
        return materialize(df, *args, **kw)

    materialize = sequence.materialize
    dataset.step_log(spark, SF_SMALL)  # prepared before
    monkeypatch.setattr(sequence, "materialize", written)
    kept = {"student", "problem", "step", "first_tx", "_kc_pid", "_kc_mid", "_kc_in"}
    dataset.problem_view(spark, SF_SMALL)
    dataset.renumber_rows(spark, SF_SMALL)
    assert seen == [kept, kept | {"split"}]


def test_written_tables_are_compressed(spark):
    from kcflow.operators.sequence import materialize

    files = materialize(spark.range(9), "compressed").inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_step_log_is_numbered_where_it_is_joined(spark, monkeypatch):
    """No line item is written before the log, and the numbers are those of the slices,
    which orders or parts beyond a slice still get."""
    from kcflow.operators import sequence
    from kcflow.sources import fixtures

    seen = []

    def written(df, *args, **kw):
        seen.append(set(df.columns))
        return materialize(df, *args, **kw)

    materialize = sequence.materialize
    monkeypatch.setattr(sequence, "materialize", written)
    joined = fixtures.build_step_log(spark, SF_SMALL)
    assert len(seen) == 1 and not {"l_linenumber", "l_extendedprice"} & seen[0]
    for most in (0, 6):  # no group is whole; the orders are, the parts are not
        monkeypatch.setattr(fixtures, "WHOLE_GROUP_ROWS", most)
        sliced_log = fixtures.build_step_log(spark, SF_SMALL)
        assert sorted(map(str, sliced_log.collect())) == sorted(map(str, joined.collect()))
    assert any("l_extendedprice" in columns for columns in seen)


def test_step_log_of_repeated_and_missing_keys(spark, tmp_path):
    """An order or a part that is there twice doubles its rows, and one that is missing
    takes no number."""
    from kcflow.sources.fixtures import build_step_log

    day = "timestamp_ntz'2020-01-02 00:00:00'"

    def numbers(name, orders, parts):
        spark.sql(f"""SELECT o AS l_orderkey, p AS l_partkey, 3L AS l_suppkey, n AS l_linenumber,
            5D AS l_quantity, 2000D AS l_extendedprice, 0.1D AS l_discount, 0.1D AS l_tax,
            'O' AS l_linestatus, {day} AS l_shipdate FROM VALUES (1L, 7L, 1), (1L, 8L, 2), (2L, 7L, 1),
            (null, 7L, 1), (2L, null, 2), (3L, 9L, 1) AS t(o, p, n)""").write.parquet(
                f"{tmp_path}/{name}/lineitem.parquet")
        spark.createDataFrame(orders, "o_orderkey long").selectExpr(
            "o_orderkey", "2L AS o_custkey", "'O' AS o_orderstatus", f"{day} AS o_orderdate") \
            .write.parquet(f"{tmp_path}/{name}/orders.parquet")
        spark.createDataFrame(parts, "p_partkey long").selectExpr(
            "p_partkey", "'red' AS p_name", "'b' AS p_brand", "'tin' AS p_type", "4 AS p_size") \
            .write.parquet(f"{tmp_path}/{name}/part.parquet")
        rows = build_step_log(spark, f"{tmp_path}/{name}").collect()
        return sorted((r.row, r.l_orderkey, r.l_partkey, r.problem_view) for r in rows)

    keys = [(1,), (2,), (3,), (None,)]
    whole = [(1, 1, 7, 1), (2, 1, 8, 1), (3, 2, 7, 2), (4, 3, 9, 1)]
    assert numbers("whole", keys, [(7,), (8,), (9,), (None,)]) == whole
    assert numbers("no_part", keys, [(7,), (9,)]) == [(1, 1, 7, 1), (2, 2, 7, 2), (3, 3, 9, 1)]
    assert numbers("no_order", keys[:1], [(7,), (8,), (9,)]) == whole[:2]
    twice = numbers("order_twice", [*keys, (3,)], [(7,), (8,), (9,)])
    assert twice == [*whole, (5, 3, 9, 2)]
    assert numbers("part_twice", keys, [(7,), (8,), (9,), (9,)]) == twice
