"""Session construction and cluster-facing settings."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a deployment should own; values here are the local defaults and are
# only applied when building a new session (an existing session keeps its own).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Parquet scans: 128 MB splits keep tasks spill-free on typical executors.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ledgerline", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a home.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we use it as
    is.  Only a local-mode session (tests, the bench) without that setting gets a
    private scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a shared (DFS) folder for checkpoints")
    path = tempfile.mkdtemp(prefix="ledgerline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


#: Spark removes a step's shuffle files when the step ends, not when the driver collects garbage; a
#: task that writes into several folders keeps this many files open and sorts only beyond that.
LEAN_STEPS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
              "spark.sql.maxConcurrentOutputFileWriters": "100"}


@contextmanager
def lean_steps(spark: SparkSession):
    """What is written here leaves no shuffle files behind and is not sorted by folder."""
    old = {k: spark.conf.get(k, None) for k in LEAN_STEPS}
    for k, v in LEAN_STEPS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


#: Rows of a player and month that one task groups and orders.
COHORT_ROWS_A_TASK = 200_000


def counted_parts(df: DataFrame, rows_a_task: int) -> int:
    """As many parts as the rows of ``df`` ask for, and no fewer than the session's.  Rows are
    counted, so ``df`` should be stored: of a stored table a count reads no column."""
    return max(shuffle_partitions(df.sparkSession), -(-df.count() // rows_a_task))
