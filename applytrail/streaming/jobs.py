"""Intake, enrichment and resolution as streaming queries.

Each query takes what has arrived and stops (``availableNow``), so a scheduler can start
it daily; its checkpoint remembers which files are done. Every batch writes to a folder
named by its number, which makes a replayed batch overwrite itself.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from applytrail.functions.dates import parse_mixed_utc
from applytrail.operators.enrich import analyse, split_quarantine
from applytrail.operators.mail import ANALYSIS_FIELDS, BOOLEAN_FIELDS, CLEAN_FIELDS, INTEGER_FIELDS, clean_message, content_key, with_message_key
from applytrail.operators.matching import RULE, MatchRule
from applytrail.operators.resolve import resolve
from applytrail.sources.readers import INBOX_OPTIONS, INBOX_SCHEMA, inbox_columns
from applytrail.sources.scratch import cut
from applytrail.sources.sinks import read_store, write_upsert

# Records handled per run.
ANALYSES_PER_BATCH = 120

CLEAN_STREAM_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in (*CLEAN_FIELDS, "message_key")])


def _field_type(name: str) -> T.DataType:
    if name in BOOLEAN_FIELDS:
        return T.BooleanType()
    return T.IntegerType() if name in INTEGER_FIELDS else T.StringType()


ANALYSED_STREAM_SCHEMA = T.StructType([
    *CLEAN_STREAM_SCHEMA.fields,
    T.StructField("analysis", T.StructType([T.StructField(f, _field_type(f)) for f in ANALYSIS_FIELDS])),
])


def _start(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def intake_stream(spark: SparkSession, source: str, out: str, quarantine: str, checkpoint: str,
                  archive: str | None = None, files_per_batch: int | None = None) -> StreamingQuery:
    """New raw inbox files, cleaned and keyed. Handled files move to ``archive``.

    A mail is taken once: its message key and content are kept in the query's state, so a copy
    in a later batch is left out, and a replayed batch finds the state it had. The folder a
    file lies in says nothing about its state: the files of the newest batch are only moved
    once a later batch runs.
    """
    reader = spark.readStream.schema(INBOX_SCHEMA).options(**INBOX_OPTIONS)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def handle(batch: DataFrame, number: int) -> None:
        # written once: mails are cleaned ahead of the state, in Python
        good, bad = split_quarantine(cut(batch, "intake"))
        good.select(*CLEAN_STREAM_SCHEMA.names).write.mode("overwrite").parquet(f"{out}/run={number}")
        bad.select(*CLEAN_FIELDS, "error").write.mode("overwrite").json(f"{quarantine}/run={number}")

    raw = inbox_columns(reader.json(source))
    clean = with_message_key(clean_message(raw))
    # unreadable files have no content to know them by: each is kept under its name
    told = F.when(F.col("error").isNull(), content_key()).otherwise(F.concat(F.lit("file "), F.col("filename")))
    return _start(clean.withColumn("content", told).dropDuplicates(["message_key", "content"]), handle, checkpoint)


def enrich_stream(spark: SparkSession, clean: str, out: str, quarantine: str, checkpoint: str,
                  extractor: Callable[[pd.Series], pd.Series],
                  files_per_batch: int = ANALYSES_PER_BATCH) -> StreamingQuery:
    """New clean mails through the extractor, to ``out`` or, where it failed, ``quarantine``."""
    stream = (
        spark.readStream.schema(CLEAN_STREAM_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch).parquet(f"{clean}/run=*")
    )

    def handle(batch: DataFrame, number: int) -> None:
        # written once: the extractor must not run again for the second branch
        analysed = cut(analyse(batch, extractor), "enrich")
        good, bad = split_quarantine(analysed)
        good.select(*ANALYSED_STREAM_SCHEMA.names).write.mode("overwrite").parquet(f"{out}/run={number}")
        bad.write.mode("overwrite").json(f"{quarantine}/run={number}")

    return _start(stream, handle, checkpoint)


def resolve_stream(spark: SparkSession, analysed: str, jobs: Callable[[], DataFrame], store: str,
                   checkpoint: str, asof: Callable[[], str], rule: MatchRule = RULE,
                   files_per_batch: int | None = None) -> StreamingQuery:
    """New analysed mails resolved against the store and the current board export.

    ``jobs`` and ``asof`` are asked once per batch. The store must exist; a batch writes
    store folder ``number + 1``, so it and its replay are one and the same upsert.
    """
    reader = spark.readStream.schema(ANALYSED_STREAM_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def handle(batch: DataFrame, number: int) -> None:
        folder = number + 1
        mail = batch.withColumn("date", parse_mixed_utc(F.col("date")))
        now = F.lit(asof()).cast("timestamp")
        docs = resolve(mail, jobs(), read_store(spark, store, folder), now, rule)
        write_upsert(spark, store, docs, folder)

    return _start(reader.parquet(f"{analysed}/run=*"), handle, checkpoint)
