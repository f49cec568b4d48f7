"""What the operators of this package share: table access, word rules, intermediate tables."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import TypeVar
from uuid import uuid4

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import applytrail.session  # noqa: F401  (functions and classes of the package travel by value)
from applytrail.sources.scratch import shared_folder

# white space that separates words: blank, tab, line feed, vertical tab, form feed, carriage return
SPACE = r"[\x20\x09-\x0D]+"

ARROW_SETTINGS = {
    # texts are long: small Arrow batches keep a Python worker's memory bounded
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 * 1024 * 1024),
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in ARROW_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(c: str = "text") -> Column:
    """The text itself; null counts as empty."""
    return F.coalesce(F.col(c), F.lit(""))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


Value = TypeVar("Value")


def shipped(spark: SparkSession, value: Value) -> Callable[[], Value]:
    """A broadcast of a value of the package's own classes, which executors need not have installed.

    Called in a task, the result is the task's own copy. Callers bound the value's size.
    """
    data = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(data.value)


def fold(c: Column, folds: int) -> Column:
    """crc32 of an id's decimal text, modulo ``folds``; a null id falls in fold 0."""
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % folds, F.lit(0)).cast("int")


def chosen(df: DataFrame, rows: int, key: str = "id") -> DataFrame:
    """The ``rows`` rows whose keys have the smallest hashes: the same ones whatever the layout.

    The rows are counted first, so that only about twice as many as wanted are sorted and no
    task passes on more. ``df`` is read twice.
    """
    return sampled(df, 2 * rows, key).orderBy(F.xxhash64(key), key).limit(rows)


def sampled(df: DataFrame, rows: int, key: str) -> DataFrame:
    """About ``rows`` rows, those whose keys' hashes lie under a bound: a count, a filter, no shuffle."""
    place = F.xxhash64(key) / F.lit(2.0 ** 64) + 0.5
    return df.where(place <= min(1.0, rows / max(df.count(), 1)))
