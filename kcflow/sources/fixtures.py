"""The step log and transaction log derived from the driver tables.

The driver tables hold no tutoring log, so a fixed mapping turns line items
into step records (one per line item) and events into transactions.  The
mapping is part of the test contract and is stated once here; the DuckDB
twin lives in ``kcflow.plans.oracle``.

Scale notes: ``lineitem JOIN orders`` is a big-big equi join on the order
key; ``part`` joins on the part key and AQE broadcasts it only when its
measured size is small.  ``row`` and ``problem_view`` are running numbers.
Where no order and no part has more rows than a slice (it is measured), they
are taken in the layout of these two joins, and the rows are moved for nothing
else; otherwise both come from the slices of ``running_index``, which never
puts one key's rows into one task.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sequence import COMPRESSION, WHOLE_GROUP_ROWS, running_index, running_sum
from ..session import default_partitions, ensure_checkpoint_dir, file_exists, file_versions, \
    release_scratch, scratch_group
from .tables import spread, table

# Fixed values of the fixture mapping (they must equal the documented view).
TEST_STATUS = "P"            # orders with this status go to the test split
TEST_CUSTKEY_MOD = 37        # ... and so do customers with custkey % 37 = 0
NEVER_CORRECT_MOD = 50       # custkey % 50 = 0: learner never right first time
LEARNER_MOD = 20             # learner effect: quantity + custkey % 20 < 45
LEARNER_LIMIT = 45
ONE_KC_DISCOUNT = 0.05       # discount below: one KC, else two
WITHHELD_LINESTATUS = "F"    # test rows with this status have no label
FLAGS = ("no_tax", "one_kc", "withheld")
KC_SEP = "~~"

# Line-item columns that make a step record unique (quantity and price break
# the one duplicate of the first four at sf0.001).
ITEM_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
             "l_quantity", "l_extendedprice")

STEP_COLUMNS = ("row", "split", "student", "hierarchy", "problem", "problem_view", "step",
                "step_start", "first_tx", "correct_tx", "step_end", "dur", "correct_dur",
                "error_dur", "cfa", "incorrects", "hints", "corrects", "kc", "opportunity",
                "truth")


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The driver tables in the columns that ``_records`` maps: narrow, as every
    shuffle moves them.  What a record only asks about is a flag before the first,
    and the three flags of a line item (true, false or null) are one number."""
    flags = {"no_tax": F.col("l_tax") == 0, "one_kc": F.col("l_discount") < ONE_KC_DISCOUNT,
             "withheld": F.col("l_linestatus") == WITHHELD_LINESTATUS}
    li = table(spark, sf_dir, "lineitem").select(*ITEM_KEYS, "l_shipdate", sum(
        F.coalesce(flags[f].cast("int"), F.lit(2)) * 3**i for i, f in enumerate(FLAGS)).alias("flags"))
    test = (F.col("o_orderstatus") == TEST_STATUS) | (F.col("o_custkey") % TEST_CUSTKEY_MOD == 0)
    od = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate",
        F.coalesce(test, F.lit(False)).alias("is_test"))
    pt = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_name", "p_size",
        F.concat_ws(", ", "p_type", "p_brand").alias("hierarchy"))
    return li, od, pt


def _flag(name: str) -> Column:
    digit = F.floor(F.col("flags") / 3**FLAGS.index(name)) % 3
    return F.when(digit < 2, digit == 1)


def _split() -> Column:
    return F.when(F.col("is_test"), "test").otherwise("train")


def _with_part(rows: DataFrame, pt: DataFrame) -> DataFrame:
    """The texts of the part are the record's once it is joined."""
    kc = (F.when(_flag("no_tax"), F.lit(None).cast("string"))
          .when(_flag("one_kc"), F.substring_index("p_name", " ", 1))
          .otherwise(F.replace("p_name", F.lit(" "), F.lit(KC_SEP))))
    return rows.join(pt, "l_partkey").withColumn("kc", kc).drop("p_name")


def _records(j: DataFrame, *numbers: str) -> DataFrame:
    """The step records of the joined rows (FIXTURES.md s2)."""
    cust = F.col("o_custkey")
    no_tax, one_kc, split = _flag("no_tax"), _flag("one_kc"), _split()
    truth = (F.when(cust % NEVER_CORRECT_MOD == 0, F.lit(0))
             .when(F.col("l_quantity") + cust % LEARNER_MOD < LEARNER_LIMIT, F.lit(1))
             .otherwise(F.lit(0))).cast("int")
    qty = F.col("l_quantity").cast("int").cast("string")
    price_s = F.col("l_extendedprice") / 1000
    return j.select(
        *ITEM_KEYS, *numbers,
        split.alias("split"),
        F.concat(F.lit("S"), cust.cast("string")).alias("student"),
        "hierarchy",
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("problem"),
        F.concat(F.lit("T"), F.col("l_linenumber").cast("string"), F.lit("_"),
                 F.col("p_size").cast("string")).alias("step"),
        F.when(~no_tax, F.col("o_orderdate")).alias("step_start"),
        F.col("o_orderdate").alias("first_tx"),
        F.when(truth == 1, F.col("l_shipdate")).alias("correct_tx"),
        F.col("l_shipdate").alias("step_end"),
        F.when(~no_tax, price_s).alias("dur"),
        F.when(truth == 1, price_s).alias("correct_dur"),
        F.when(truth == 0, price_s).alias("error_dur"),
        F.when((split == "test") & _flag("withheld"),
               F.lit(None)).otherwise(truth).cast("int").alias("cfa"),
        (1 - truth).cast("bigint").alias("incorrects"),
        (F.col("l_linenumber") % 3).cast("bigint").alias("hints"),
        F.lit(1).cast("bigint").alias("corrects"),
        "kc",
        F.when(no_tax, F.lit(None).cast("string"))
         .when(one_kc, qty)
         .otherwise(F.concat(qty, F.lit(KC_SEP), F.col("l_linenumber").cast("string")))
         .alias("opportunity"),
        truth.alias("truth"),
    )


# Rows per prepared file, roughly (about 100 MB of step records), and the
# fewest rows worth a file of their own when spreading small data over cores.
ROWS_PER_FILE = 1_000_000
MIN_ROWS_PER_FILE = 10_000
INPUTS = ("lineitem", "orders", "part")


def build_step_log(spark: SparkSession, sf_dir: str, *, with_row: bool = True,
                   with_view: bool = True) -> DataFrame:
    """The step-record table computed from the driver tables (FIXTURES.md s2).

    ``row`` is 1..n per split in line-item key order; ``problem_view`` the
    running count per (student, problem) in time order.  The joined rows are
    numbered as they are: the student is the customer and the problem the part,
    and the wider records are made last.  Rows with the same texts lie together
    where they are written and moved, as the part comes first in the layout.
    """
    li, od, pt = _inputs(spark, sf_dir)
    # number of slices by the rows of lineitem, which the join cannot exceed
    n = _files(spark, table(spark, sf_dir, "lineitem").count())
    largest = _largest_part(li, pt)
    orders = _order_starts(li, od, n) if largest else None
    if orders is not None:
        df = _numbered_in_joins(li, *orders, pt, n, largest)
    else:
        df = _numbered_in_slices(li, od, pt, n, with_row, with_view)
    numbers = [c for c, wanted in (("problem_view", with_view), ("row", with_row)) if wanted]
    df = _records(df, *numbers)
    cols = [c for c in STEP_COLUMNS if c in df.columns]
    return df.select(*cols, *ITEM_KEYS)


def _largest_part(li: DataFrame, pt: DataFrame) -> int | None:
    """The most line items of a part, if every line item has exactly one part (so that
    the join keeps the rows as they are) and no part more than fits a slice."""
    lines = li.where("l_partkey IS NOT NULL").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    known = pt.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("m"))
    most, fewest, twice = lines.join(known, "l_partkey", "left").agg(
        F.max("n"), F.min(F.coalesce("m", F.lit(0))), F.max("m")).first()
    return most if fewest == twice == 1 and most <= WHOLE_GROUP_ROWS else None


def _order_starts(li: DataFrame, od: DataFrame, n: int) -> tuple[DataFrame, int] | None:
    """Orders with ``start``, the rows of their split before them, and the most rows of
    an order, if no order is there twice or has more rows than fit a slice."""
    lines = li.where("l_partkey IS NOT NULL").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"))
    once = od.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("m"), F.min("o_custkey").alias("o_custkey"),
        F.min("o_orderdate").alias("o_orderdate"),
        F.bool_or("is_test").alias("is_test"))
    upto = running_sum(once.join(lines, "l_orderkey"), ["is_test"], ["l_orderkey"], "n", "upto", n)
    twice, most = upto.agg(F.max("m"), F.max("n")).first()
    if most is None or twice > 1 or most > WHOLE_GROUP_ROWS:
        return None
    return upto.select("l_orderkey", "o_custkey", "o_orderdate", "is_test",
                       (F.col("upto") - F.col("n")).alias("start")), most


def _numbered_in_joins(li: DataFrame, orders: DataFrame, most: int, pt: DataFrame, n: int,
                       largest: int) -> DataFrame:
    """Rows numbered where the joins have dealt them: ``row`` by the order's start and the
    place in the order, ``problem_view`` among the rows of the part."""
    def dealt(rows: DataFrame, key: str) -> DataFrame:
        """More tasks than the session's default when the rows need them."""
        return rows.repartition(n, key) if n > default_partitions(rows.sparkSession) else rows

    df = dealt(li.where("l_partkey IS NOT NULL"), "l_orderkey").join(orders, "l_orderkey")
    df = running_index(df, ["l_orderkey"], list(ITEM_KEYS[1:]), "row", largest=most)
    df = df.withColumn("row", F.col("start") + F.col("row")).drop("start")
    df = _with_part(dealt(df, "l_partkey"), pt)
    return running_index(df, ["l_partkey", "o_custkey"], ["o_orderdate", *ITEM_KEYS],
                         "problem_view", largest=largest)


def _numbered_in_slices(li: DataFrame, od: DataFrame, pt: DataFrame, n: int, with_row: bool,
                        with_view: bool) -> DataFrame:
    """Joined rows numbered by slices, whatever an order or a part holds (AQE splits the
    hot keys of the joins).  Slices are in order of the part first (a group is the same
    either way), so that equal texts compress together."""
    li = spread(li, ["l_orderkey", "l_linenumber", "l_partkey"])
    df = _with_part(li.join(od, "l_orderkey"), pt)
    if with_view:
        df = running_index(df, ["l_partkey", "o_custkey"], ["o_orderdate", *ITEM_KEYS],
                           "problem_view", num_partitions=n)
    if with_row:
        df = running_index(df, ["is_test"], list(ITEM_KEYS), "row", num_partitions=n)
    return df


def _files(spark: SparkSession, rows: int) -> int:
    """Files by row count; small data gets one per core."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, min(cores, -(-rows // MIN_ROWS_PER_FILE)), -(-rows // ROWS_PER_FILE))


def prepared_path(spark: SparkSession, sf_dir: str) -> str:
    """The prepared step table of an input folder, built when it is not there.

    The step log is the library's input, as the step files are for the
    reference: it is written once as parquet, partitioned by split, in the
    shared checkpoint folder, and read by every query.  Its name is a digest
    of the names, sizes and times of the input files, so changed inputs are
    prepared anew and nothing is remembered in the process.
    """
    version = hashlib.sha256(repr([
        (t, file_versions(spark, f"{sf_dir.rstrip('/')}/{t}.parquet")) for t in INPUTS]).encode())
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kcflow-step-log-{version.hexdigest()[:24]}"
    if not file_exists(spark, f"{path}/_SUCCESS"):
        group = f"prepare-{uuid.uuid4().hex[:12]}-"
        with scratch_group(spark, group):
            build_step_log(spark, sf_dir).write.mode("overwrite").option(
                "compression", COMPRESSION).partitionBy("split").parquet(path)
        release_scratch(spark, group)  # the numberings are in the written table
    return path


def step_log(spark: SparkSession, sf_dir: str, *, with_row: bool = False,
             with_view: bool = True, keep_keys: bool = False) -> DataFrame:
    """The step-record table, read from the prepared parquet copy.

    Columns are pruned at the scan; a filter on ``split`` prunes partitions.
    ``keep_keys`` adds the line-item key columns (the time-order tie-break).
    """
    df = spark.read.parquet(prepared_path(spark, sf_dir))
    cols = [c for c in STEP_COLUMNS
            if (c != "row" or with_row) and (c != "problem_view" or with_view)]
    if keep_keys:
        cols += list(ITEM_KEYS)
    return df.select(*cols)


# Event types of the transaction mapping (fixed values).
OUTCOME_OF_EVENT = {"purchase": "correct", "error": "incorrect", "view": "hint",
                    "click": "other", "signup": "other"}
PROBLEMS_IN_EVENTS = 10


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions for the step roll-up (FIXTURES.md section 3)."""
    return transactions_of(table(spark, sf_dir, "events"))


def transactions_of(ev: DataFrame) -> DataFrame:
    """The transaction mapping over an events frame (batch or stream)."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    outcome = F.lit(None).cast("string")
    for e, o in reversed(list(OUTCOME_OF_EVENT.items())):
        outcome = F.when(F.col("event_type") == e, F.lit(o)).otherwise(outcome)
    return ev.select(
        F.col("event_id").alias("tx_id"),
        F.col("ts").alias("tx_time"),
        F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("student"),
        F.concat(F.lit("Q"), (k % PROBLEMS_IN_EVENTS).cast("string")).alias("problem"),
        F.lit("main").alias("step"),
        outcome.alias("outcome"),
        F.col("value").alias("tx_dur"),
    )
