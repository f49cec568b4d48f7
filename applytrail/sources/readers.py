"""Readers. Every schema is stated, columns are picked by name."""

from __future__ import annotations

import email
import warnings
from collections.abc import Iterator
from email import policy

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from applytrail.functions.dates import BOARD_ZONE, parse_mixed, parse_us_date
from applytrail.functions.text import clean_bool, nullify
from applytrail.operators.mail import CLEAN_FIELDS, RAW_ANALYSIS_TYPE, conform_analysis
from applytrail.operators.rows import union_sources
from applytrail.operators.savedjobs import saved_jobs
from applytrail.sources.records import LARGE, is_large, joined, pieces
from applytrail.sources.scratch import spread


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


INBOX_FIELDS = {"Subject": "subject", "Body": "body", "To": "to", "From": "from", "Cc": "cc",
                "DateTimeReceived": "date"}
INBOX_SCHEMA = T.StructType([*_strings(INBOX_FIELDS).fields, T.StructField("_corrupt", T.StringType())])
INBOX_OPTIONS = {"multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
CSV_OPTIONS = {"multiLine": "true", "escape": '"'}
CLEAN_SCHEMA = T.StructType([*_strings(CLEAN_FIELDS).fields, T.StructField("analysis", RAW_ANALYSIS_TYPE)])
APPLICATION_FIELDS = ("Application Date", "Company Name", "Job Title", "Job Url", "Question And Answers")
# fixed values: how the phrase between two blocks ends, and what stands before that
BLOCK_END, BLOCK_END_AFTER = "Add note", r"(?U)Notes\s*\z"
MIME_SCHEMA = _strings((*CLEAN_FIELDS, "error"))


def inbox_columns(raw: DataFrame) -> DataFrame:
    """Inbox payloads under the clean-mail names; ``error`` marks unreadable files.

    Bytes that are no UTF-8 reach us as replacement characters and are dropped.
    """
    def readable(c: str) -> Column:
        return F.regexp_replace(F.coalesce(F.col(c), F.lit("")), "�", "")

    named = [readable(c).alias(n) for c, n in INBOX_FIELDS.items()]
    return raw.select(
        F.col("_metadata.file_name").alias("filename"), *named,
        F.when(F.col("_corrupt").isNotNull(), F.lit("unreadable")).alias("error"),
    ).select(*CLEAN_FIELDS, "error")


def read_inbox(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw inbox JSON, one payload per file."""
    return inbox_columns(spark.read.schema(INBOX_SCHEMA).options(**INBOX_OPTIONS).json(path))


def read_emails(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Clean mail JSON from several folders, extracted fields nested and typed.

    A mail without extracted fields has a null ``analysis``.
    """
    raw = spark.read.schema(CLEAN_SCHEMA).option("multiLine", True).json(paths)
    return raw.withColumn("analysis", F.when(F.col("analysis").isNotNull(), conform_analysis(F.col("analysis"))))


def parse_mime(content: bytes) -> dict[str, str]:
    """Headers and the preferred body (plain before HTML) of one MIME message."""
    message = email.message_from_bytes(content, policy=policy.default)
    headers = {k: str(message.get(k, "")) for k in ("To", "From", "Subject", "Cc", "Date")}
    part = message.get_body(preferencelist=("plain", "html"))
    body = part.get_content() if part is not None else ""
    return {**{k.lower(): v for k, v in headers.items()}, "body": body}


def _mime_row(content: bytes) -> dict[str, str | None]:
    """A parsed message, or what kept it from being parsed."""
    try:
        return {**parse_mime(content), "error": None}
    except Exception as e:  # whatever a damaged mail raises, it must not stop the others
        return {"error": f"{type(e).__name__}: {e}"}


def _mime_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        parsed = pd.DataFrame([_mime_row(c) for c in batch["content"]], index=batch.index,
                              columns=[*CLEAN_FIELDS, "error"], dtype=object)
        parsed["filename"] = batch["filename"]
        yield parsed


def read_mime(spark: SparkSession, path: str) -> DataFrame:
    """MIME files as raw messages, ready for ``clean_message``; ``error`` marks unreadable ones."""
    files = spark.read.format("binaryFile").load(path)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("filename"), "content")
    return named.mapInPandas(_mime_rows, MIME_SCHEMA)


def read_quoted_csv(spark: SparkSession, path: str, limit: int = LARGE) -> DataFrame:
    """CSV with a header and quoted line breaks, all columns text; large files are read by ranges.

    A line ends a record if the quotes up to it are even in number. That asks for what CSV
    writers do: a value that holds a quote is quoted, and the quote is doubled. Lines end in
    LF or CRLF, and a file's first line is its header; blank lines are no records.
    """
    whole = spark.read.options(header=True, **CSV_OPTIONS).csv(path)
    value = F.col("value")
    quotes = F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))
    records = joined(pieces(spark, path, "\n", limit), "\n", lambda parity: parity == 0, quotes).where(~F.col("first"))
    lines = records.select(F.regexp_replace("value", r"\r?\n\z", "").alias("value")).where(value != "")
    schema = ", ".join(f"`{c.replace('`', '``')}` STRING" for c in whole.columns)
    ranged = lines.select(F.from_csv("value", schema, CSV_OPTIONS).alias("row")).select("row.*")
    return whole.where(~is_large(limit)).union(ranged)


def read_applications_csv(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """Application exports; a missing file is reported and skipped, none at all gives None."""
    frames = []
    for path in paths:
        try:
            found = read_quoted_csv(spark, path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            warnings.warn(f"no file at {path}, skipped", stacklevel=2)
            continue
        frames.append(found.select(*[F.col(f"`{c}`") for c in APPLICATION_FIELDS if c in found.columns]))
    return union_sources(*frames) if frames else None


def application_metadata(df: DataFrame) -> DataFrame:
    """Export columns under the feature-table names."""
    return df.withColumnsRenamed({c: c.replace(" ", "_") for c in APPLICATION_FIELDS[:4]})


def read_feature_csv(spark: SparkSession, path: str, month_first: bool = False) -> DataFrame:
    """Feature table: index column dropped, types restored, undated rows left out.

    ``Application_Date`` is a board date; ``month_first`` reads it as month-first only.
    """
    raw = read_quoted_csv(spark, path)
    columns = []
    for c in raw.columns:
        value = F.col(f"`{c}`")
        if c in ("", "_c0"):
            continue
        if c == "Application_Date":
            value = parse_us_date(value) if month_first else parse_mixed(value, BOARD_ZONE)
        elif c.startswith("Req_Years_"):
            value = value.try_cast("double").cast("int")
        elif c.startswith(("Ask_", "Req_")):
            value = clean_bool(value)
        else:
            value = nullify(value)
        columns.append(value.alias(c))
    return raw.select(*columns).dropna(subset=["Application_Date"])


def feature_jobs(features: DataFrame) -> DataFrame:
    """Feature table as board jobs for matching."""
    return features.withColumnsRenamed({
        "Application_Date": "application_date", "Company_Name": "company_name",
        "Job_Title": "job_title", "Job_Url": "job_url",
    })


def read_dumps(spark: SparkSession, path: str | list[str], limit: int = LARGE) -> DataFrame:
    """Pasted dumps: a small file as one text, a large one as a text per job block.

    Ranges of a large file are cut at the end of the phrase that parts two blocks; where that
    end stands alone, it parts nothing and both sides are one text again.
    """
    small = spark.read.text(path, wholetext=True).where(~is_large(limit)).select("value")
    blocks = joined(pieces(spark, path, BLOCK_END, limit), BLOCK_END, lambda _: F.col("value").rlike(BLOCK_END_AFTER))
    return spread(small).union(blocks.select("value"))


def read_saved_jobs(spark: SparkSession, path: str | list[str], asof: Column, limit: int = LARGE) -> DataFrame:
    """Pasted dumps, one or several jobs a file, parsed to saved jobs."""
    return saved_jobs(read_dumps(spark, path, limit), asof)


def sync_missing(source: DataFrame, done: DataFrame, key: str = "filename") -> DataFrame:
    """Records whose file has not been handled yet."""
    return source.join(done.select(key), key, "left_anti")
