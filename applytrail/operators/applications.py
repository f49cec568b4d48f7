"""One row per application: mail and board summaries, their outer join, corrections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from applytrail.operators.rows import latest_status

KEYS = ["company_clean", "role_clean"]

# Mail categories behind each milestone.
PERSONALITY_TEST = "Personality Test Request"
TECHNICAL_TEST = "Technical Test Request"
INTERVIEW = "Interview Invitation"
CONFIRMATION = "Confirmation of Application"
AUTO_REPLY = "Bot/Auto-Reply"
REJECTION = "Rejection"
BOARD_REJECTION = "Not moving forward"
NO_MAIL_STATUS = "Pending / No Email"


def has_value(column: str, value: str) -> Column:
    return F.coalesce(F.col(column) == value, F.lit(False))


def is_confirmation() -> Column:
    """Confirmations are recognised in any case: both spellings are in use."""
    return F.coalesce(F.lower("update_category") == CONFIRMATION.lower(), F.lit(False))


def automated() -> Column:
    return F.coalesce(F.col("is_automated"), F.lit(False))


def is_interview() -> Column:
    invited = has_value("update_category", INTERVIEW) | has_value("notification_type", "Interview")
    return invited & ~automated()


def is_rejection() -> Column:
    return has_value("update_category", REJECTION) | has_value("notification_type", REJECTION)


def _flag(condition: Column) -> Column:
    return F.max(condition.cast("int"))


def mail_milestones(mail: DataFrame) -> DataFrame:
    """Mail counts, first date and milestone flags per (company, role).

    The distinct count is first reduced per (key, category), so a hot key reaches
    its final task as a handful of rows.
    """
    return mail.groupBy(F.col("company_clean").alias("m_company"), F.col("role_clean").alias("m_role")).agg(
        F.count_distinct("update_category").alias("distinct_roles"),
        F.count("company_clean").alias("mail_count"),
        F.min("date").alias("mail_date"),
        _flag(has_value("update_category", PERSONALITY_TEST)).alias("has_p_test"),
        _flag(has_value("update_category", TECHNICAL_TEST)).alias("has_t_test"),
        _flag(is_interview()).alias("has_interview"),
        _flag(is_rejection()).alias("is_rejected_mail"),
        _flag(is_confirmation()).alias("is_confirmation"),
        _flag(automated() | has_value("update_category", AUTO_REPLY)).alias("is_automated"),
    )


def job_groups(jobs: DataFrame) -> DataFrame:
    """Board entries per (company, role)."""
    return jobs.groupBy(F.col("company_clean").alias("l_company"), F.col("role_clean").alias("l_role")).agg(
        F.count("company_clean").alias("linkedin_count"),
        F.min("applied_date").alias("linkedin_date"),
        _flag(has_value("outcome", BOARD_REJECTION)).alias("is_rejected_li"),
    )


def join_groups(mail_groups: DataFrame, board_groups: DataFrame) -> DataFrame:
    """Outer join of the two summaries; both arrive hashed on the key, one row per key."""
    on = (F.col("m_company") == F.col("l_company")) & (F.col("m_role") == F.col("l_role"))
    zero = F.lit(0)
    flags = ["has_p_test", "has_t_test", "is_confirmation", "is_automated", "has_interview"]
    return mail_groups.join(board_groups, on, "full_outer").select(
        F.coalesce("m_company", "l_company").alias("company_clean"),
        F.coalesce("m_role", "l_role").alias("role_clean"),
        *[F.coalesce(F.col(c), zero).alias(c) for c in flags],
        F.greatest(
            F.coalesce("is_rejected_mail", zero), F.coalesce("is_rejected_li", zero)
        ).alias("is_rejected"),
        *[F.coalesce(F.col(c), zero.cast("long")).alias(c)
          for c in ("distinct_roles", "mail_count", "linkedin_count")],
        F.least("mail_date", "linkedin_date").alias("first_applied_date"),
    )


def unify_applications(mail: DataFrame, jobs: DataFrame) -> DataFrame:
    """Every application seen in mail, on the board, or both."""
    return join_groups(mail_milestones(mail), job_groups(jobs))


def verified_funnel(apps: DataFrame) -> DataFrame:
    """Flags and first date, grouped once more by key."""
    return apps.groupBy(*KEYS).agg(
        F.max("has_p_test").alias("has_p_test"),
        F.max("has_t_test").alias("has_t_test"),
        F.max((F.col("has_interview") == 1).cast("int")).alias("has_interview"),
        F.max("is_rejected").alias("is_rejected"),
        F.min("first_applied_date").alias("first_date"),
    )


def attach_latest_status(mail: DataFrame, jobs: DataFrame, tie: str = "filename") -> DataFrame:
    """Applications with the category of their newest mail."""
    newest = latest_status(mail, tie).select(
        F.col("company_clean").alias("m_company"), F.col("role_clean").alias("m_role"),
        F.col("update_category").alias("_status"),
    )
    summary = mail_milestones(mail).join(newest, ["m_company", "m_role"], "left")
    on = (F.col("m_company") == F.col("l_company")) & (F.col("m_role") == F.col("l_role"))
    zero = F.lit(0).cast("long")
    return summary.join(job_groups(jobs), on, "full_outer").select(
        F.coalesce("m_company", "l_company").alias("company_clean"),
        F.coalesce("m_role", "l_role").alias("role_clean"),
        F.coalesce("_status", F.lit(NO_MAIL_STATUS)).alias("application_status"),
        *[F.coalesce(F.col(c), zero).alias(c) for c in ("distinct_roles", "mail_count", "linkedin_count")],
        F.least("mail_date", "linkedin_date").alias("first_applied_date"),
    )


def apply_overrides(df: DataFrame, fixes: DataFrame, flags: tuple[str, ...]) -> DataFrame:
    """Hand corrections by company, or by company and role when ``fixes`` has a role.

    ``fixes`` holds one row per key with a nullable column per flag. It is typed in
    by a person, so it is joined plainly and the planner may broadcast it by its size.
    """
    keys = [k for k in KEYS if k in fixes.columns]
    renamed = fixes.select(
        *[(F.lower(F.col(k)) if k == "company_clean" else F.col(k)).alias(k) for k in keys],
        *[F.col(f).alias(f"_fix_{f}") for f in flags],
    )
    joined = df.join(renamed, keys, "left")
    fixed = {f: F.coalesce(F.col(f"_fix_{f}"), F.col(f)) for f in flags}
    return joined.select(*[fixed.get(c, F.col(c)).alias(c) for c in df.columns])
