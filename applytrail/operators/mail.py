"""Mail tables: parsing extracted fields, conforming, filtering, projecting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from applytrail.functions import text as X
from applytrail.functions.dates import parse_mixed_each, parse_mixed_utc
from applytrail.operators.rows import pick_one

# The extracted fields, in their documented order.
ANALYSIS_FIELDS = (
    "company_applied_for", "portal", "type", "role", "category", "is_automated", "urgency",
    "interview_type", "interview_platform", "interview_date_iso", "test_platform",
    "test_duration_mins", "application_deadline_iso", "action_required", "action_type",
    "action_deadline_iso", "work_mode", "location", "recruiter_name", "recruiter_email", "summary",
)
BOOLEAN_FIELDS = ("is_automated", "action_required")
INTEGER_FIELDS = ("test_duration_mins",)

# Extracted fields that go by another name in the mail table.
RENAMED_FIELDS = {
    "company_applied_for": "company",
    "type": "notification_type",
    "category": "update_category",
    "interview_date_iso": "interview_date",
    "application_deadline_iso": "application_deadline",
    "action_deadline_iso": "action_deadline",
}

# Closed value lists of the extracted fields.
ENUMS = {
    "type": ("Job ad", "Application update", "Rejection", "Offer", "Unrelated", "Unknown"),
    "category": (
        "Job Ad", "Recruiter Reach-out", "Bot/Auto-Reply", "Confirmation of Application",
        "Rejection", "Request for Information", "Technical Test Request",
        "Personality Test Request", "Interview Invitation", "Job Offer", "Not Job Related", "Unknown",
    ),
    "urgency": ("High", "Medium", "Low"),
    "interview_type": ("Online-Live", "In-Person", "One-Way-Robot", "Phone-Call", "Unclear"),
    "action_type": (
        "Respond", "Click Link", "Schedule Interview", "Submit Document", "Take Test", "Do Nothing",
    ),
    "work_mode": ("Remote", "Hybrid", "On-site"),
}

CLEAN_FIELDS = ("filename", "to", "from", "subject", "cc", "date", "body")

# Columns kept for analysis, in order.
KEPT_COLUMNS = (
    "uid", "date", "notification_type", "update_category", "company", "role", "urgency",
    "action_required", "action_type", "is_automated", "portal", "from", "interview_platform",
    "interview_type", "summary",
)

# every extracted field is read as text: a typed reader would turn "true" into null
RAW_ANALYSIS_TYPE = T.StructType(
    [T.StructField(f, T.StringType()) for f in (*ANALYSIS_FIELDS, "error")]
)


def conform_analysis(raw: Column) -> Column:
    """All-text extracted fields to their types; placeholder words become null."""
    fields = []
    for name in ANALYSIS_FIELDS:
        value = raw[name]
        if name in BOOLEAN_FIELDS:
            value = X.clean_bool(value)
        elif name in INTEGER_FIELDS:
            value = X.clean_int(value)
        else:
            value = X.nullify(value)
        fields.append(value.alias(name))
    return F.struct(*fields)


def parse_analysis(df: DataFrame, source: str = "analysis_json") -> DataFrame:
    """JSON text to ``analysis`` and ``error``; unreadable text only fills ``error``.

    The text must be one JSON object. A reported ``error`` member is passed on.
    """
    schema = T.StructType([*RAW_ANALYSIS_TYPE.fields, T.StructField("_bad", T.StringType())])
    raw = F.from_json(F.col(source), schema, {"columnNameOfCorruptRecord": "_bad"})
    # behind a generator the text is parsed once, not once per field
    df = df.select("*", F.explode(F.array(raw)).alias("_raw"))
    bad = F.col("_raw._bad").isNotNull() | F.col("_raw").isNull() | ~F.trim(source).startswith("{")
    return (
        df.withColumn("analysis", F.when(~bad, conform_analysis(F.col("_raw"))))
        .withColumn("error", F.when(bad, F.lit("unparseable")).otherwise(F.col("_raw.error")))
        .drop("_raw")
    )


def flatten_analysis(df: DataFrame) -> DataFrame:
    """Nested extracted fields next to the mail fields, under the mail-table names."""
    nested = [F.col("analysis")[f].alias(RENAMED_FIELDS.get(f, f)) for f in ANALYSIS_FIELDS]
    return df.select(*CLEAN_FIELDS, *nested, F.lit("email").alias("record_type"))


def conform(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns; a value that does not fit becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})


def conform_dates(df: DataFrame, columns: tuple[str, ...] = (
    "date", "interview_date", "application_deadline", "action_deadline",
)) -> DataFrame:
    """The named text columns as instants."""
    found = [c for c in columns if c in df.columns]
    if not found:
        return df
    read = df.withColumn("_dates", parse_mixed_each(found))
    return read.withColumns({c: F.get("_dates", F.lit(i)) for i, c in enumerate(found)}).drop("_dates")


def drop_unrelated(df: DataFrame) -> DataFrame:
    """Drop advertisements and unrelated mail. A missing type is kept."""
    return df.filter(~F.coalesce(F.col("notification_type").isin("Unrelated", "Job ad"), F.lit(False)))


def drop_empty(df: DataFrame) -> DataFrame:
    """Drop hand-written mail of unknown type whose descriptive fields are all placeholders."""
    def placeholder(name: str) -> Column:
        return F.col(name).isNull() | F.col(name).isin(*X.ANALYSIS_PLACEHOLDERS)

    empty = (
        F.coalesce(F.col("notification_type") == "Unknown", F.lit(False))
        & placeholder("company") & placeholder("role")
        & ~F.coalesce(F.col("is_automated"), F.lit(False))
        & placeholder("portal") & placeholder("action_type")
    )
    return df.filter(~empty)


def select_analysis_columns(df: DataFrame) -> DataFrame:
    df = df.withColumn("uid", X.uid(F.col("filename")))
    return df.select(*KEPT_COLUMNS).withColumn(
        "company", F.when(F.col("company") != "Unknown", F.col("company"))
    )


def rejections(df: DataFrame) -> DataFrame:
    return df.filter("update_category = 'Rejection' OR notification_type = 'Rejection'")


def project_mail(df: DataFrame) -> DataFrame:
    return df.select("role_clean", "company_clean", "date", "update_category",
                     "notification_type", "is_automated", "portal")


def project_quick_apply(df: DataFrame) -> DataFrame:
    return df.select("role_clean", "company_clean", "linkedin_date")


def project_saved_jobs(df: DataFrame) -> DataFrame:
    return df.select("role_clean", "company_clean", "location", "work_type", "applied_date")


def split_by_prefix(df: DataFrame, prefixes: tuple[str, ...], keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """Prefixed columns plus ``keep`` in one frame, everything else in the other."""
    chosen = [c for c in df.columns if c.startswith(prefixes)]
    rest = [c for c in df.columns if c not in chosen]
    return df.select(*chosen, *keep), df.select(*rest)


def drop_unkeyed(df: DataFrame, columns: tuple[str, ...] = ("company_clean",),
                 words: tuple[str, ...] = ("", "none")) -> DataFrame:
    """Drop rows whose key columns are missing or placeholder words."""
    for c in columns:
        df = df.filter(~F.lower(X.strip(F.coalesce(F.col(c), F.lit("")))).isin(*words))
    return df


def with_clean_keys(df: DataFrame, company: str = "company", role: str = "role") -> DataFrame:
    """Add the grouping keys ``company_clean`` and ``role_clean``."""
    return df.withColumns(
        {"company_clean": X.company_clean(F.col(company)), "role_clean": X.role_clean(F.col(role))}
    )


def with_sender_keys(df: DataFrame) -> DataFrame:
    """Grouping keys where a missing company falls back on the sender's domain."""
    return df.withColumns({
        "company_clean": F.coalesce(X.company_or_sender(F.col("company"), F.col("from")), F.lit("unknown")),
        "role_clean": X.role_clean(F.col("role")),
    })


def validate_enums(df: DataFrame) -> DataFrame:
    """Rows and distinct offending values per closed field, from one pass over the mails."""
    checks = [
        F.when(
            F.col("analysis")[name].isNotNull() & ~F.col("analysis")[name].isin(*allowed),
            F.struct(F.lit(name).alias("field"), F.col("analysis")[name].alias("value")),
        )
        for name, allowed in ENUMS.items()
    ]
    found = df.select(F.inline(F.array_compact(F.array(*checks))))
    return found.groupBy("field", "value").agg(F.count(F.lit(1)).alias("mails"))


def clean_message(df: DataFrame) -> DataFrame:
    """Subject and body of a raw message, cleaned in place."""
    return df.withColumns({
        "subject": X.clean_subject(F.col("subject")),
        "body": X.clean_body(F.col("body")),
    })


def with_message_key(df: DataFrame) -> DataFrame:
    """Deterministic name of the clean record, from send time and sender."""
    return df.withColumn("message_key", X.message_key(
        parse_mixed_utc(F.col("date")), F.col("from"), F.col("filename")))


def content_key() -> Column:
    """What tells two mails of one ``message_key`` apart: whole sender, receiver, subject and body.

    Only true copies agree in it; the message key alone has whole seconds and a shortened sender.
    """
    return X.content_digest(*[F.col(c) for c in ("from", "to", "subject", "body")])


def distinct_mails(df: DataFrame) -> DataFrame:
    """One mail per message key and content; of true copies the last file name stays."""
    return pick_one(df.withColumn("_content", content_key()), ["message_key", "_content"],
                    [F.col("filename").desc_nulls_last()]).drop("_content")
