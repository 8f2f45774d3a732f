"""Spark session helpers.

The checkpoint folder is read from the session (``spark.checkpoint.dir`` or the
SparkContext's checkpoint dir).  Only when neither is set and the master is
``local`` (tests: one process, one disk) a temp folder is chosen; on a cluster a
missing setting is an error, because the folder must be on shared storage.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "barloom", driver_memory: str = "8g") -> SparkSession:
    """Session with settings the library relies on (UTC, AQE, UI off)."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", driver_memory))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; set a temp one only if none is set and the master is local."""
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="barloom-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    Used where later steps depend on physical facts of a computed layout
    (partition ids, ids assigned within a sorted partition); a lost executor
    then re-reads the written files instead of recomputing a different layout.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def dealt_by_rows(df: DataFrame, rows_per_task: int, rows: int | None = None, at_least: int = 1) -> DataFrame:
    """``df`` dealt over one partition per ``rows_per_task`` rows, if these are fewer than the session's shuffle partitions.

    For tables that many passes read: a pass costs tasks, and every task's report goes to the driver, so their
    number follows the rows and not the session's setting.  ``rows``: the count, if known."""
    n = max(at_least, -(-(df.count() if rows is None else rows) // rows_per_task))
    return df.repartition(n) if n < shuffle_partitions(df.sparkSession) else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def default_parallelism(spark: SparkSession) -> int:
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # pragma: no cover - connect sessions
        return os.cpu_count() or 8
