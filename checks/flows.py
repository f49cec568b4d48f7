"""Readers and streams over files that Spark writes from the driver tables first."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from applytrail.operators import mail as M
from applytrail.sources import readers, sinks
from applytrail.sources.scratch import shared_folder
from applytrail.streaming import jobs as J
from checks.registry import ORACLES, asof, query
from checks.standins import ctes, table
from checks.texts import ANALYSED, FIELDS
from checks.whole import exports

MAILS_PER_FILE = 2000
FILES_PER_FOLDER = 500


def folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


def write_payloads(payloads: DataFrame, path: str) -> None:
    """JSON texts (event_id, json) as files that hold one array of some thousand each, some hundred files a folder."""
    part = F.floor(F.col("event_id") / MAILS_PER_FILE)
    arrays = payloads.groupBy(part.alias("part")).agg(F.array_sort(F.collect_list("json")).alias("all"))
    texts = arrays.select(F.floor(F.col("part") / FILES_PER_FOLDER).alias("folder"), F.concat(F.lit("["), F.array_join("all", ",\n"), F.lit("]")).alias("value"))
    texts.write.option("maxRecordsPerFile", 1).partitionBy("folder").text(path)


# --- mail files ------------------------------------------------------------------

@query("read_emails", f"{ANALYSED} SELECT filename, \"date\", \"from\", \"to\", subject, cc, body, {', '.join(FIELDS)} FROM analysed")
def _(spark, sf_dir):
    mails = table(spark, sf_dir, "emails")
    plain = F.to_json(F.struct(*M.CLEAN_FIELDS))
    fields = F.when(F.get_json_object("analysis_json", "$").isNotNull(), F.col("analysis_json")).otherwise(F.lit("null"))
    payloads = mails.withColumn("plain", plain).select(
        "event_id", F.concat(F.expr("left(plain, length(plain) - 1)"), F.lit(', "analysis": '), fields, F.lit("}")).alias("json"))
    path = folder(spark, "emails")
    for name, rest in (("processed", 0), ("unprocessed", 1)):
        write_payloads(payloads.where(F.col("event_id") % 2 == rest), f"{path}/{name}")
    read = readers.read_emails(spark, [f"{path}/processed/*", f"{path}/unprocessed/*"])
    return read.select(*M.CLEAN_FIELDS, *[
        F.col("analysis")[f].alias(n) for f in M.ANALYSIS_FIELDS if (n := M.RENAMED_FIELDS.get(f, f)) in FIELDS])


def inbox(spark, sf_dir) -> DataFrame:
    """Mails as raw inbox payloads."""
    mails = table(spark, sf_dir, "emails")
    return mails.select("event_id", F.to_json(F.struct(*[F.col(n).alias(c) for c, n in readers.INBOX_FIELDS.items()])).alias("json"))


@query("read_inbox", f"""WITH {ctes('emails')} SELECT "to", "from", subject, cc, "date", body, NULL::VARCHAR AS error FROM emails""")
def _(spark, sf_dir):
    path = folder(spark, "inbox")
    write_payloads(inbox(spark, sf_dir), path)
    return readers.read_inbox(spark, path).drop("filename")


# --- pasted dumps and exports, read by ranges -------------------------------------

@query("saved_jobs_files", f"SELECT * EXCLUDE (o_orderkey) FROM ({ORACLES['saved_jobs']})")
def _(spark, sf_dir):
    path = folder(spark, "dumps")
    table(spark, sf_dir, "dumps").select("value").write.text(path)
    return readers.read_saved_jobs(spark, path, asof(), limit=0)


@query("quoted_csv_ranges", f"""WITH {ctes('questions')} SELECT strftime(o_orderdate, '%-m/%-d/%Y') AS "Application Date",
  o_orderpriority AS "Company Name", 'Clerk' AS "Job Title", o_orderkey::VARCHAR AS "Job Url",
  replace(answers, ' | ', chr(10)) AS "Question And Answers" FROM questions""")
def _(spark, sf_dir):
    path = folder(spark, "exports")
    lines = F.replace("Question And Answers", F.lit(" | "), F.lit("\n"))
    sinks.write_snapshot_csv(exports(spark, sf_dir).withColumn("Question And Answers", lines), path)
    return readers.read_quoted_csv(spark, path, limit=0)


# --- streams -----------------------------------------------------------------------

def taken_in(spark, sf_dir) -> str:
    """Clean mails of two runs; the second run's files are copies of the first's, and a third more mails."""
    path, mails = folder(spark, "intake"), inbox(spark, sf_dir)
    for run, given in enumerate((mails.where(F.col("event_id") % 3 > 0), mails)):
        write_payloads(given, f"{path}/in/run={run}")
        J.intake_stream(spark, f"{path}/in/*/*", f"{path}/clean", f"{path}/bad", f"{path}/state").awaitTermination()
    return path


@query("intake_stream", f"""WITH {ctes('emails')} SELECT "to", "from", subject, cc, "date", body,
  (epoch_us(ts) // 1000)::VARCHAR || '_' || substring(regexp_replace("from", '[^a-zA-Z0-9]', '_', 'g'), 1, 40) AS message_key FROM emails""")
def _(spark, sf_dir):
    clean = spark.read.schema(J.CLEAN_STREAM_SCHEMA).parquet(f"{taken_in(spark, sf_dir)}/clean/run=*")
    return clean.drop("filename")


@query("enrich_stream", f"""WITH {ctes('emails')} SELECT subject, CASE WHEN event_id % 10 = 7 THEN 'quarantine' ELSE 'good' END AS side,
  CASE WHEN event_id % 10 <> 7 THEN 'Rejection' END AS category, CASE WHEN event_id % 10 <> 7 THEN length(subject) END::INT AS minutes FROM emails""")
def _(spark, sf_dir):
    def extractor(texts):
        subject = texts.str.extract(r"^Email Subject: (.*)\n\nEmail Body: ", expand=False)
        told = '{"category": "Rejection", "test_duration_mins": ' + subject.str.len().astype(str) + "}"
        return told.where(~subject.str.endswith("7"), "cut o")

    path = taken_in(spark, sf_dir)
    J.enrich_stream(spark, f"{path}/clean", f"{path}/analysed", f"{path}/failed", f"{path}/enriched", extractor).awaitTermination()
    good = spark.read.schema(J.ANALYSED_STREAM_SCHEMA).parquet(f"{path}/analysed/run=*")
    bad = spark.read.schema("subject string").json(f"{path}/failed/run=*")
    return good.select("subject", F.lit("good").alias("side"), F.col("analysis.category").alias("category"),
                       F.col("analysis.test_duration_mins").alias("minutes")).union(
        bad.select("subject", F.lit("quarantine"), F.lit(None).cast("string"), F.lit(None).cast("int")))
