"""Spark session helpers.

Cluster settings (shuffle partitions, checkpoint dir, memory) come from the
cluster's own configuration; ``get_session`` only fills in values that are
unset, which is what tests and the local bench need.
"""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

# Settings this library relies on. AQE re-plans joins at runtime (broadcast
# when the measured side is small, split skewed partitions), coalesces small
# shuffle partitions, and ANSI mode stays on (we use try_* functions).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "basketry",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    # settings the operator has made (spark-defaults, spark-submit, a running session) stay
    given = SparkConf()
    running = SparkSession.getActiveSession()
    conf = {k: v for k, v in DEFAULT_CONF.items()
            if not given.contains(k) and (running is None or running.conf.get(k, None) is None)}
    if master and master.startswith("local"):
        # local mode: the driver JVM is the whole cluster
        conf.setdefault("spark.driver.memory", os.environ.get("BASKETRY_DRIVER_MEMORY", "8g"))
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
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is a shared filesystem path set by the operator. Only
    a local master without the setting (tests) gets a scratch folder of our own; on any other
    master its absence is an error, since executors cannot see each other's disks.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder (master {master})")
        path = tempfile.mkdtemp(prefix="basketry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used between iterative steps (model search loops, resampling rounds)
    so a lost executor recomputes from the checkpoint, not from the scan.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_lineage_lean(df: DataFrame) -> DataFrame:
    """``cut_lineage`` for rows of line grain: the shuffle files of making them go when they are written,
    not at some later collection."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name)
    conf.set(name, "true")
    try:
        return cut_lineage(df.select("*"))  # planned anew, under this setting
    finally:
        conf.set(name, before)
