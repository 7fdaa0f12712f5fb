"""Session helpers.

Library code never creates its own cluster settings; it reads what the
session carries.  ``local_session`` is for tests, the bench and the CLI
examples only.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "kcflow") -> SparkSession:
    """A local session tuned like a small cluster: AQE on, UI off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("KCFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only when nothing is configured and the master is local (tests,
    local runs) a private folder is created; a cluster without the setting
    is an error, since a machine-local folder would not be shared.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="kcflow-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def ensure_worker_path(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did.

    On a cluster the package is installed or sent along; a checkout that only
    the driver put on its path is added here.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def file_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def file_versions(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, size, modification time) of a file or of the files in a folder,
    in any file system that Spark reads."""
    fs, p = _file_system(spark, path)
    return sorted((str(f.getPath()), f.getLen(), f.getModificationTime())
                  for f in fs.listStatus(p))


def release_scratch(spark: SparkSession, group: str = "") -> None:
    """Remove every table that the library has written to the shared folder in
    this application (under the ``scratch_group`` of that name, if one is
    given).  To be called when results that read them have been consumed;
    prepared inputs are built again when needed."""
    fs, base = _file_system(spark, ensure_checkpoint_dir(spark))
    for f in fs.listStatus(base):
        if f.getPath().getName().startswith(f"kcflow-{group}"):
            fs.delete(f.getPath(), True)


SCRATCH_GROUP = "kcflow.scratch.group"


@contextmanager
def scratch_group(spark: SparkSession, group: str):
    """Tables written inside carry ``group`` in their name, so that they can be
    released together."""
    before = spark.conf.get(SCRATCH_GROUP, "")
    spark.conf.set(SCRATCH_GROUP, group)
    try:
        yield
    finally:
        spark.conf.set(SCRATCH_GROUP, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/kcflow-{spark.conf.get(SCRATCH_GROUP, '')}{name}-{uuid.uuid4().hex[:12]}"


def default_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
