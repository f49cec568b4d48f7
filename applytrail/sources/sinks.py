"""Writers. The application store is in ``store``; its functions are offered here too."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from applytrail.operators.mail import distinct_mails, with_message_key
from applytrail.operators.rows import union_sources
from applytrail.sources.scratch import cut
from applytrail.sources.store import compact, init_store, next_number, read_store, write_upsert

__all__ = ["compact", "init_store", "next_number", "read_store", "write_clean", "write_quarantine", "write_snapshot_csv", "write_upsert"]

PART = "key_part"
PARTS = 64   # folders clean mails are dealt into by a hash of their message key


def write_clean(df: DataFrame, path: str, fmt: str = "json", parts: int = PARTS) -> None:
    """Add clean mails to a folder, under a deterministic key; of true copies the last file name stays.

    The folder is partitioned by a hash of the key. Only the partitions that new mails fall
    into are read and replaced; the others stay as they are, and so do their files.
    """
    spark = df.sparkSession
    part = F.pmod(F.xxhash64("message_key"), F.lit(parts)).cast("int")
    new = cut(with_message_key(df).withColumn(PART, part), "clean")
    touched = [r[PART] for r in new.select(PART).distinct().collect()]
    rows = new
    try:
        old = spark.read.schema(new.schema).format(fmt).load(path).where(F.col(PART).isin(touched))
        rows = union_sources(old, new)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    # written aside first: the partitions that are replaced are read from the folder itself
    whole = cut(distinct_mails(rows), "clean-parts")
    whole.repartition(PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).format(fmt).save(path)


def write_snapshot_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, escape='"').csv(path)


def write_quarantine(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)
