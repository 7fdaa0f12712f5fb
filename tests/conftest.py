import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (SparkSession.builder.master("local[*]")
         .appName("kcflow-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="kcflow-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def edge(spark):
    """The hand-written edge rows of FIXTURES.md section 4."""
    rows = [
        ("train", "A", "Unit 1, Sec 1", "p1", "s1", 1, "x~~y", "3~~5", 4.0),
        ("train", "A", "Unit 1, Sec 1", "p1", "s2", 0, "x", "1", None),
        ("train", "B", "Unit 1, Sec 2, b", "p1", "s1", 0, None, None, None),
        ("train", "C", "NoComma", "p2", "s3", 1, "NA", "2", 100.0),
        ("train", "B", "Unit 2, Sec 1", "p3", "s1", 0, "z", "7", None),
        ("test", "A", "Unit 1, Sec 1", "p1", "s1", None, "x~~y", "4~~6", None),
        ("test", "D", "Unit 9, Sec 9", "p9", "s9", None, "w", None, None),
        ("test", "C", "NoComma", "p2", "s3", 0, None, "5", None),
    ]
    schema = ("split string, student string, hierarchy string, problem string, step string, "
              "cfa int, kc string, opportunity string, dur double")
    df = spark.createDataFrame(rows, schema)
    # 'NA' is a null spelling: normalise it as the TSV reader does.
    from kcflow.sources.tsv import normalise
    from pyspark.sql import functions as F
    return df.withColumn("kc", normalise("kc")).withColumn("row", F.monotonically_increasing_id())
