"""From mails, board jobs and the store to application records."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from applytrail.functions import text as X
from applytrail.operators.mail import ANALYSIS_FIELDS
from applytrail.operators.matching import RULE, MatchRule, best_match
from applytrail.operators.orphans import UNKNOWN, orphan_jobs
from applytrail.operators.rows import first_per_key, last_per_key, pick_one, union_sources
from applytrail.sources.scratch import cut

# Record types, and the board columns every record has.
RECORD_TYPE = "job_application"
BOARD_COLUMNS = {
    "linkedin_job_url": "string",
    "linkedin_application_date": "timestamp",
    "linkedin_company_name": "string",
    "linkedin_job_title": "string",
}
MAIL_KEY = "mail_key"
MAIL_COLUMNS = ("filename", "to", "from", "subject", "date", "body", "analysis")
JOB_COLUMNS = ("application_date", "company_name", "job_title", "job_url")


def prefix_columns(df: DataFrame, prefix: str = "linkedin_", skip: tuple[str, ...] = JOB_COLUMNS) -> list[Column]:
    """Remaining columns under lower-case prefixed names without special characters."""
    return [
        F.col(f"`{c}`").alias(prefix + re.sub(r"[^a-zA-Z0-9_]", "_", c).lower())
        for c in df.columns if c.lower() not in {s.lower() for s in skip}
    ]


def board_jobs(jobs: DataFrame) -> DataFrame:
    """Board jobs with their keys and the ``linkedin_*`` columns their records carry.

    ``job_ref`` orders and identifies a job: entries equal in it are the same entry.
    """
    digest = X.job_hash(F.col("company_name"), F.col("job_title"), F.col("application_date"))
    keyed = jobs.select(
        *JOB_COLUMNS,
        digest.alias("job_hash"),
        F.concat_ws("|", digest, F.coalesce("job_url", F.lit(""))).alias("job_ref"),
        X.slug(F.col("company_name"), F.col("job_title"), F.col("application_date")).alias("job_id"),
        F.nullif(F.col("job_url"), F.lit("")).alias("linkedin_job_url"),
        F.col("application_date").alias("linkedin_application_date"),
        F.nullif(F.col("company_name"), F.lit("")).alias("linkedin_company_name"),
        F.nullif(F.col("job_title"), F.lit("")).alias("linkedin_job_title"),
        *prefix_columns(jobs),
    )
    return pick_one(keyed, ["job_ref"], [F.col("job_ref")])


def mail_names(mail: DataFrame) -> DataFrame:
    """Mails with the company and role the match reads; missing ones are empty."""
    return mail.withColumns({
        "company": F.coalesce(X.nullify(F.col("analysis.company_applied_for")), F.lit("")),
        "role": F.coalesce(X.nullify(F.col("analysis.role")), F.lit("")),
    })


def to_application(df: DataFrame, record_type: str, asof: Column) -> DataFrame:
    """The flat application record.

    Reads ``job_id, company_name, job_title, application_date`` plus the mail columns
    (mail records) and any ``linkedin_*`` columns; absent ones become null.
    """
    is_mail = record_type == "email"
    blank = F.lit(None).cast("string")

    def mail_text(name: str) -> Column:
        return F.nullif(F.col(name), F.lit("")) if is_mail else blank

    board = [
        (F.col(c) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in BOARD_COLUMNS.items()
    ]
    extra = [F.col(c) for c in df.columns if c.startswith("linkedin_") and c not in BOARD_COLUMNS]
    analysis = {"is_automated": "boolean", "action_required": "boolean", "test_duration_mins": "int"}
    return df.select(
        (X.email_id(F.col("job_id"), F.col("filename")) if is_mail
         else F.concat("job_id", F.lit("_linkedin"))).alias("id"),
        F.lit(RECORD_TYPE).alias("type"),
        "job_id",
        X.partition_key(F.col("company_name")).alias("partitionKey"),
        F.lit(record_type).alias("record_type"),
        "company_name",
        X.norm_company(F.col("company_name")).alias("company_normalized"),
        "job_title",
        X.norm_title(F.col("job_title")).alias("job_title_normalized"),
        "application_date",
        asof.alias("created_at"),
        asof.alias("updated_at"),
        (F.col("filename") if is_mail else blank).alias("email_filename"),
        (F.col("date") if is_mail else F.lit(None).cast("timestamp")).alias("email_date"),
        mail_text("to").alias("email_to"),
        mail_text("from").alias("email_from"),
        mail_text("subject").alias("email_subject"),
        (X.preview(F.col("body")) if is_mail else blank).alias("email_body_preview"),
        *[(F.col("analysis")[f] if is_mail else F.lit(None).cast(analysis.get(f, "string"))).alias(f"analysis_{f}")
          for f in ANALYSIS_FIELDS],
        *board, *extra,
        *([F.col(MAIL_KEY).alias("email_key")] if MAIL_KEY in df.columns else []),
    )


def inherit_board_fields(docs: DataFrame, masters: DataFrame) -> DataFrame:
    """Fill missing ``linkedin_*`` columns of records from their job's master record.

    Of several masters of a job, that of the smallest ``job_ref`` (without one, of the smallest
    fields) counts, so every record stays one row.
    """
    fields = [c for c in masters.columns if c.startswith("linkedin_")]
    order = ["job_ref"] if "job_ref" in masters.columns else fields
    named = pick_one(masters, ["job_id"], [F.col(c).asc_nulls_last() for c in order]).select("job_id", *[F.col(c).alias(f"_m_{c}") for c in fields])
    joined = docs.join(named, "job_id", "left")
    filled = [
        F.coalesce(F.col(c), F.col(f"_m_{c}")).alias(c) if c in docs.columns else F.col(f"_m_{c}").alias(c)
        for c in fields
    ]
    return joined.select(*[c for c in docs.columns if c not in fields], *filled)


def match_store(mail: DataFrame, store: DataFrame, rule: MatchRule = RULE) -> DataFrame:
    """Best stored application per mail, at any distance in time."""
    masters = first_per_key(store).select("job_id", "company_name", "job_title", "application_date")
    return best_match(mail, masters, "job_id", None, rule)


def match_board(mail: DataFrame, jobs: DataFrame, rule: MatchRule = RULE) -> DataFrame:
    """Best board job per mail, at most twice the tolerance apart."""
    return best_match(mail, jobs, "job_ref", 2 * rule.tolerance_days, rule)


def unmatched_jobs(jobs: DataFrame, matched: DataFrame, slugs: DataFrame) -> DataFrame:
    """Jobs neither matched by a mail (``job_hash``) nor known to the store (``job_id``), one per slug."""
    free = jobs.join(matched.select("job_hash").distinct(), "job_hash", "left_anti").join(
        slugs.select("job_id").distinct(), "job_id", "left_anti")
    return pick_one(free, ["job_id"], [F.col("job_ref")])


def orphan_leaders(orphans: DataFrame) -> DataFrame:
    """One new job per normalised name among unmatched mails, named after its first mail.

    A name with an empty part says too little: such mails share a job only within a day.
    The winner per name is a running minimum, so a name held by very many mails is
    reduced map-side before it is joined back.
    """
    keyed = orphans.withColumns({
        "_company": X.norm_company(F.col("company")), "_title": X.norm_title(F.col("role"))})
    blank = (F.coalesce("_company", F.lit("")) == "") | (F.coalesce("_title", F.lit("")) == "")
    keyed = keyed.withColumn("_day", F.when(blank, F.coalesce(F.date_format("date", "yyyyMMdd"), F.lit("unknown"))).otherwise(""))
    first = keyed.groupBy("_company", "_title", "_day").agg(
        F.min(F.struct(F.col("date").isNull().alias("undated"), "date", "filename", "company", "role")).alias("_f"))
    unknown = F.lit(UNKNOWN)
    leaders = first.select(
        "_company", "_title", "_day",
        X.slug(F.col("_f.company"), F.col("_f.role"), F.col("_f.date")).alias("job_id"),
        F.coalesce(F.nullif(F.col("_f.company"), F.lit("")), unknown).alias("company_name"),
        F.coalesce(F.nullif(F.col("_f.role"), F.lit("")), unknown).alias("job_title"),
        F.col("_f.date").alias("application_date"),
    )
    return keyed.join(leaders, ["_company", "_title", "_day"]).drop("_company", "_title", "_day")


def one_per_mail(mail: DataFrame) -> DataFrame:
    """Mails under ``mail_key``, a digest of file name, date, sender and content.

    File names repeat between folders; only true copies share a key, and one of them stays.
    """
    told = [F.col(c) for c in ("filename", "from", "to", "subject", "body", "company", "role")]
    return mail.withColumn(MAIL_KEY, X.content_digest(*told, F.unix_micros("date").cast("string"))).dropDuplicates([MAIL_KEY])


def keyed_by_mail(mail: DataFrame) -> DataFrame:
    """The mails as ``best_match`` reads them, the key in the place of the file name."""
    return mail.withColumn("filename", F.col(MAIL_KEY))


def settled_ids(docs: DataFrame, store: DataFrame) -> DataFrame:
    """Mail records under ids that no other mail has.

    The id built from the file name goes to the mail that has it in the store, else to the one of the
    least key; other mails of that name and job take their key instead. A mail that comes again
    gets the id it had.
    """
    least = docs.where("email_key IS NOT NULL").groupBy("id").agg(F.min("email_key").alias("_least"))
    if "email_key" in store.columns:
        held = store.join(least.select("id"), "id", "left_semi").groupBy("id").agg(F.min("email_key").alias("_held"))
        least = least.join(held, "id", "left").select("id", F.coalesce("_held", "_least").alias("_least"))
    own = F.col("email_key").isNull() | (F.col("email_key") == F.col("_least"))
    named = F.when(own, F.col("id")).otherwise(F.concat_ws("_", "job_id", "email_key"))
    return docs.join(least, "id", "left").withColumn("id", named).drop("_least")


def resolve(mail: DataFrame, jobs: DataFrame, store: DataFrame, asof: Column, rule: MatchRule = RULE) -> DataFrame:
    """Records to upsert for a batch of mails and the current board export.

    A mail belongs to its best stored application, else to its best board job, else to a
    job another mail of the batch was matched to, else to the job of an earlier unmatched mail
    of a similar name, or to its own (``orphan_jobs``). Board jobs nobody claimed become records too.
    Every mail is one record; true copies of a mail are one mail.
    The outcome does not depend on the order or partitioning of the inputs.
    """
    # records hold the opening of a body only, so no more of it is written out
    mail = one_per_mail(mail_names(mail.select(*MAIL_COLUMNS))).withColumn("body", X.preview(F.col("body")))
    mail = cut(mail, "resolve-mail")
    board = cut(board_jobs(jobs.filter(F.col("application_date").isNotNull())), "resolve-board")
    board_fields = [c for c in board.columns if c.startswith("linkedin_")]
    master_fields = [c for c in store.columns if c.startswith("linkedin_")]
    name = ["job_id", "company_name", "job_title", "application_date"]
    masters = cut(first_per_key(store).select(*name, *master_fields), "resolve-masters")

    stored = cut(best_match(keyed_by_mail(mail), masters.select(*name), "job_id", None, rule).withColumnRenamed("filename", MAIL_KEY), "resolve-stored")
    in_store = mail.join(stored.select(MAIL_KEY, "job_id"), MAIL_KEY).join(
        masters, "job_id")

    rest = mail.join(stored, MAIL_KEY, "left_anti")
    on_board = cut(match_board(keyed_by_mail(rest), board, rule).withColumnRenamed("filename", MAIL_KEY), "resolve-on-board")
    claimed = board.join(on_board.select("job_ref").distinct(), "job_ref", "left_semi")
    from_board = rest.join(on_board.select(MAIL_KEY, "job_ref"), MAIL_KEY).join(
        board.select("job_ref", *name, *board_fields), "job_ref")

    rest = rest.join(on_board, MAIL_KEY, "left_anti")
    new_masters = cut(pick_one(claimed, ["job_id"], [F.col("job_ref")]).select(*name, *board_fields), "resolve-new")
    joined = cut(best_match(keyed_by_mail(rest), new_masters.select(*name), "job_id", None, rule).withColumnRenamed("filename", MAIL_KEY), "resolve-joined")
    with_new = rest.join(joined.select(MAIL_KEY, "job_id"), MAIL_KEY).join(new_masters, "job_id")

    orphans = cut(orphan_jobs(rest.join(joined, MAIL_KEY, "left_anti"), rule), "resolve-orphans")
    known = union_sources(*[d.select("job_id") for d in (masters, new_masters, orphans)])
    alone = unmatched_jobs(board, claimed, known)
    docs = union_sources(
        *[to_application(d, "email", asof) for d in (in_store, from_board, with_new, orphans)],
        to_application(alone, "linkedin", asof),
    )
    return last_per_key(settled_ids(cut(docs, "resolve-docs"), store), "id", ("email_date", "email_filename"))


def upsert(store: DataFrame, updates: DataFrame, key: str = "id") -> DataFrame:
    """Insert or replace by key; a replaced record keeps its first ``created_at``."""
    return union_sources(store.join(updates.select(key), key, "left_anti"), keep_created(store, updates, key))


def keep_created(store: DataFrame, updates: DataFrame, key: str = "id") -> DataFrame:
    """Updates with the creation time of the record they replace."""
    born = store.select(key, F.col("created_at").alias("_born"))
    return updates.join(born, key, "left").withColumn(
        "created_at", F.coalesce("_born", "created_at")).select(*updates.columns)
