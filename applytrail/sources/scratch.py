"""Intermediate tables that cut a plan's lineage."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

TASK_ROWS = 100_000   # rows a task gets ahead of work that is heavy per row

_local: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own: executors on
    other machines could not read it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="applytrail-")
    return _local[app]


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: several consumers, one computation.

    The table survives lost executors, and its size is known to the planner.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return spread(df.sparkSession.read.schema(df.schema).parquet(path))


def spread(scan: DataFrame) -> DataFrame:
    """A scan of at least as many partitions as there are cores.

    Only a small input, stored in too few files to occupy the cores, is reshuffled; large
    ones pass unchanged. For scans ahead of work that is heavy per row.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def tasks_for(stored: DataFrame) -> int:
    """Tasks that heavy work on a stored table's rows is dealt to: more rows, more tasks.

    A task reads whole row groups, of a million rows and more, whatever a scan's partitions
    are. Counting a table stored in columns reads no values.
    """
    return max(stored.sparkSession.sparkContext.defaultParallelism, -(-stored.count() // TASK_ROWS))


def deal(stored: DataFrame) -> DataFrame:
    """A stored table's rows in tasks of some ``TASK_ROWS`` rows."""
    return stored.repartition(tasks_for(stored))
