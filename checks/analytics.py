"""Queries over mail and job tables: grouping, joining, funnels, timelines."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from applytrail.operators import applications as A
from applytrail.operators import funnel as N
from applytrail.operators import mail as M
from applytrail.operators import rows as R
from applytrail.plans import tracker
from checks.oracle_parts import (
    OUTCOME_BY_STATE,
    APPS, EVENTS, FUNNEL, GROUPS, MAIL, NOW, OUTCOMES, REJECTED, edges,
)
from checks.registry import asof, query
from checks.standins import table


def mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.with_clean_keys(table(spark, sf_dir, "mail_rows"))


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.with_clean_keys(table(spark, sf_dir, "job_rows"))


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.unify_applications(mail(spark, sf_dir), jobs(spark, sf_dir))


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracker.application_funnel(mail(spark, sf_dir), jobs(spark, sf_dir), asof())


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.stage_events(mail(spark, sf_dir), jobs(spark, sf_dir))


def stage_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.outcome3(N.job_funnel(events(spark, sf_dir), asof()))


@query("mail_milestones", f"WITH {GROUPS} SELECT * FROM mail_groups")
def _(spark, sf_dir):
    return A.mail_milestones(mail(spark, sf_dir))


@query("job_groups", f"WITH {GROUPS} SELECT * FROM job_groups")
def _(spark, sf_dir):
    return A.job_groups(jobs(spark, sf_dir))


@query("unify_applications", f"WITH {APPS} SELECT * FROM apps")
def _(spark, sf_dir):
    return applications(spark, sf_dir)


@query("application_funnel", f"WITH {OUTCOMES} SELECT * FROM outcomes")
def _(spark, sf_dir):
    return outcomes(spark, sf_dir)


VERIFIED = f"""WITH {APPS} SELECT company_clean, role_clean, max(has_p_test) AS has_p_test, max(has_t_test) AS has_t_test,
  max(CASE WHEN has_interview = 1 THEN 1 ELSE 0 END) AS has_interview, max(is_rejected) AS is_rejected,
  min(first_applied_date) AS first_date FROM apps GROUP BY ALL"""


@query("verified_funnel", VERIFIED)
def _(spark, sf_dir):
    return A.verified_funnel(applications(spark, sf_dir))


@query("funnel_counts", f"""WITH v AS ({VERIFIED}), c AS (
  SELECT count(*) AS n_total, count(*) FILTER (WHERE has_t_test = 1) AS n_technical_test,
    count(*) FILTER (WHERE has_p_test = 1) AS n_psychometric_test, count(*) FILTER (WHERE has_interview = 1) AS n_interview,
    count(*) FILTER (WHERE is_rejected = 1) AS n_rejected,
    count(*) FILTER (WHERE is_rejected = 1 AND has_interview = 1) AS n_rejected_after_interview,
    count(*) FILTER (WHERE is_rejected = 1 AND has_interview = 0 AND (has_t_test = 1 OR has_p_test = 1)) AS n_rejected_after_test,
    count(*) FILTER (WHERE is_rejected = 0 AND first_date < {NOW} - INTERVAL 21 DAY) AS n_ghosted FROM v)
  SELECT *, n_rejected - n_rejected_after_interview - n_rejected_after_test AS n_rejected_at_screening,
    n_total - n_rejected - n_ghosted AS n_active FROM c""")
def _(spark, sf_dir):
    return N.funnel_counts(A.verified_funnel(applications(spark, sf_dir)), asof())


@query("stage_events", f"WITH {EVENTS} SELECT * FROM stage_events")
def _(spark, sf_dir):
    return events(spark, sf_dir)


@query("first_per_stage", f"WITH {EVENTS} SELECT * FROM firsts")
def _(spark, sf_dir):
    return N.first_per_stage(events(spark, sf_dir))


@query("job_funnel_outcome3", f"""WITH {FUNNEL} SELECT company_clean, role_clean, last_update,
  array_to_string(stage_list, '|') AS stages, hit_test, hit_interview, hit_rejection, days_since_update, outcome FROM funnel""")
def _(spark, sf_dir):
    return stage_funnel(spark, sf_dir).withColumn("stages", F.array_join("stage_list", "|")).drop("stage_list")


@query("outcome7_from_stages", f"""WITH {FUNNEL} SELECT company_clean, role_clean,
    {OUTCOME_BY_STATE}[1 + 4 * hit_interview::INT + 2 * hit_test::INT + hit_rejection::INT]
    [1 + coalesce(days_since_update > 21, FALSE)::INT] AS final_status FROM funnel""")
def _(spark, sf_dir):
    return N.outcome7_from_stages(stage_funnel(spark, sf_dir)).select("company_clean", "role_clean", "final_status")


START = "NOT hit_test AND NOT hit_interview"
STAGE_EDGES = [("Applied", "Assessment", "hit_test"), ("Applied", "Interview", "hit_interview AND NOT hit_test"),
               ("Assessment", "Interview", "hit_test AND hit_interview")] + [
    (stage, target, f"{reached} AND outcome = '{outcome}'")
    for stage, reached in (("Applied", START), ("Assessment", "hit_test AND NOT hit_interview"), ("Interview", "hit_interview"))
    for target, outcome in (("Rejected", "Rejection"), ("Ghosted", "Ghosted"), ("Still Active", "Active"))
]


@query("stage_flows", f"WITH {FUNNEL} {edges(STAGE_EDGES, 'funnel')}")
def _(spark, sf_dir):
    return N.stage_flows(stage_funnel(spark, sf_dir))


@query("stage_totals", f"""WITH {FUNNEL}, c AS (SELECT count(*) AS total_apps, count(*) FILTER (WHERE hit_test) AS tests,
  count(*) FILTER (WHERE hit_interview) AS interviews, count(*) FILTER (WHERE outcome = 'Ghosted') AS ghosted_total,
  count(*) FILTER (WHERE outcome = 'Active') AS active_total, count(*) FILTER (WHERE outcome = 'Rejection') AS rejected_total,
  count(*) FILTER (WHERE hit_interview AND hit_rejection) AS rej_after_interview,
  count(*) FILTER (WHERE hit_test AND NOT hit_interview AND hit_rejection) AS rej_after_test FROM funnel)
  SELECT *, rejected_total - rej_after_interview - rej_after_test AS rej_at_screening FROM c""")
def _(spark, sf_dir):
    return N.stage_totals(stage_funnel(spark, sf_dir))


NOTHING = "has_test = 0 AND has_interview = 0"
OUTCOME_EDGES = [
    ("Total Applications", "Screening Rejection", f"{NOTHING} AND is_rejected = 1"),
    ("Total Applications", "Ghosted >3 Weeks", f"{NOTHING} AND is_rejected = 0 AND days_since_app > 21"),
    ("Total Applications", "Active / Pending", f"{NOTHING} AND is_rejected = 0 AND days_since_app <= 21"),
    ("Total Applications", "Taken Assessment", "has_test = 1"),
    ("Total Applications", "Interview Stage", "has_test = 0 AND has_interview = 1"),
    ("Taken Assessment", "Failed Assessment", "has_test = 1 AND has_interview = 0 AND is_rejected = 1"),
    ("Taken Assessment", "Assessment Pending", "has_test = 1 AND has_interview = 0 AND is_rejected = 0"),
    ("Taken Assessment", "Interview Stage", "has_test = 1 AND has_interview = 1"),
    ("Interview Stage", "Interview Rejection", "has_interview = 1 AND is_rejected = 1"),
    ("Interview Stage", "Offer / Active Interview", "has_interview = 1 AND is_rejected = 0"),
]


@query("outcome_flows", f"WITH {OUTCOMES} {edges(OUTCOME_EDGES, 'outcomes')}")
def _(spark, sf_dir):
    return N.outcome_flows(applications(spark, sf_dir), asof())


@query("stage_timeline_day", f"""WITH {EVENTS} SELECT date_trunc('day', stage_date)::TIMESTAMP AS period, stage, count(*) AS events
  FROM firsts GROUP BY ALL""")
def _(spark, sf_dir):
    return N.stage_timeline(N.first_per_stage(events(spark, sf_dir)), "day")


@query("stage_timeline_week", f"""WITH {EVENTS} SELECT date_trunc('week', stage_date)::TIMESTAMP AS period, stage, count(*) AS events
  FROM firsts GROUP BY ALL""")
def _(spark, sf_dir):
    return N.stage_timeline(N.first_per_stage(events(spark, sf_dir)), "week")


@query("event_timeline", f"""WITH {EVENTS} SELECT stage_date AS "date", CASE stage WHEN 'Applied' THEN 'Application Submitted'
  WHEN 'Assessment' THEN 'Assessment Received' WHEN 'Interview' THEN 'Interview Invitation' ELSE stage END AS event_type FROM firsts""")
def _(spark, sf_dir):
    return N.event_timeline(N.first_per_stage(events(spark, sf_dir)))


@query("outcome_timeline", f"""WITH {OUTCOMES} SELECT date_trunc('day', first_applied_date)::TIMESTAMP AS apply_period, final_outcome,
  count(*) AS applications FROM outcomes GROUP BY ALL""")
def _(spark, sf_dir):
    return N.outcome_timeline(outcomes(spark, sf_dir))


@query("application_volume", f"""WITH {APPS} SELECT date_trunc('week', first_applied_date)::TIMESTAMP AS apply_period,
  count(*) AS applications FROM apps GROUP BY ALL""")
def _(spark, sf_dir):
    return N.application_volume(applications(spark, sf_dir), "week")


@query("response_rate", f"""WITH {OUTCOMES}, t AS (SELECT count(*) AS n,
    count(*) FILTER (WHERE final_outcome NOT IN ('Ghosted >3 Weeks', 'Active / Pending')) AS r FROM outcomes)
  SELECT final_outcome, count(*) AS applications, count(*)::DOUBLE / any_value(n) AS share,
    any_value(r)::DOUBLE / any_value(n) AS response_rate FROM outcomes, t GROUP BY final_outcome""")
def _(spark, sf_dir):
    return N.response_rate(outcomes(spark, sf_dir))


@query("work_type_distribution", f"WITH {MAIL} SELECT work_type, count(*) AS jobs FROM jobs GROUP BY work_type")
def _(spark, sf_dir):
    return N.work_type_distribution(jobs(spark, sf_dir))


@query("location_distribution", f"""WITH {MAIL} SELECT work_type, location, grouping(work_type, location)::BIGINT AS level,
  count(*) AS jobs FROM jobs GROUP BY ROLLUP (work_type, location)""")
def _(spark, sf_dir):
    return N.location_distribution(jobs(spark, sf_dir))


@query("distinct_total", f"WITH {GROUPS} SELECT sum(distinct_roles)::BIGINT AS distinct_total FROM mail_groups")
def _(spark, sf_dir):
    return N.distinct_total(A.mail_milestones(mail(spark, sf_dir)))


COLUMNS = ("company", "is_automated", "notification_type", "role", "update_category")


@query("profile", f"WITH {MAIL} " + " UNION ALL ".join(
    f"SELECT count(*) AS row_count, '{c}' AS column_name, count({c}) AS non_null FROM mail" for c in COLUMNS))
def _(spark, sf_dir):
    return R.profile(mail(spark, sf_dir).select(*COLUMNS))


LATEST = """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY company_clean, role_clean
  ORDER BY "date" DESC NULLS LAST, filename DESC) AS rn FROM mail) WHERE rn = 1"""


@query("latest_status", f"WITH {MAIL} {LATEST}")
def _(spark, sf_dir):
    return R.latest_status(mail(spark, sf_dir))


@query("attach_latest_status", f"""WITH {GROUPS}, latest AS ({LATEST})
  SELECT coalesce(m_company, l_company) AS company_clean, coalesce(m_role, l_role) AS role_clean,
    coalesce(latest.update_category, 'Pending / No Email') AS application_status,
    coalesce(distinct_roles, 0) AS distinct_roles, coalesce(mail_count, 0) AS mail_count, coalesce(linkedin_count, 0) AS linkedin_count,
    least(mail_date, linkedin_date) AS first_applied_date
  FROM mail_groups LEFT JOIN latest ON m_company = latest.company_clean AND m_role = latest.role_clean
  FULL OUTER JOIN job_groups ON m_company = l_company AND m_role = l_role""")
def _(spark, sf_dir):
    return A.attach_latest_status(mail(spark, sf_dir), jobs(spark, sf_dir))


@query("first_per_key", """SELECT o_custkey AS job_id, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS id,
  min(o_orderdate)::TIMESTAMP AS created_at FROM orders GROUP BY o_custkey""")
def _(spark, sf_dir):
    stored = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("job_id"), F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"))
    return R.first_per_key(stored)


@query("last_per_key", """SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
  max(o_orderdate)::TIMESTAMP AS o_orderdate FROM orders GROUP BY o_custkey""")
def _(spark, sf_dir):
    written = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"))
    return R.last_per_key(written, "o_custkey", ("o_orderdate", "o_orderkey"))


@query("most_active", f"WITH {APPS} SELECT * FROM apps ORDER BY mail_count DESC, company_clean, role_clean LIMIT 25")
def _(spark, sf_dir):
    return R.most_active(applications(spark, sf_dir), 25)


@query("most_recent", f"WITH {APPS} SELECT * FROM apps ORDER BY first_applied_date DESC NULLS LAST, company_clean, role_clean LIMIT 25")
def _(spark, sf_dir):
    return R.most_recent(applications(spark, sf_dir), 25)


@query("cap_per_run", f"WITH {MAIL} SELECT * FROM mail ORDER BY \"date\", filename LIMIT 120")
def _(spark, sf_dir):
    return R.cap(mail(spark, sf_dir), 120, ["date", "filename"])


@query("sort_by_company", f"WITH {MAIL} SELECT company, filename FROM mail")
def _(spark, sf_dir):
    return R.sort_by(mail(spark, sf_dir), "company").select("company", "filename")


@query("union_sources", f"""WITH {MAIL} SELECT company_clean, role_clean, "date", NULL::TIMESTAMP AS applied_date FROM mail
  UNION ALL SELECT company_clean, role_clean, NULL, applied_date FROM jobs""")
def _(spark, sf_dir):
    return R.union_sources(
        mail(spark, sf_dir).select("company_clean", "role_clean", "date"),
        jobs(spark, sf_dir).select("company_clean", "role_clean", "applied_date"))


@query("distinct_jobs", f"WITH {MAIL} SELECT DISTINCT company_clean, role_clean FROM jobs")
def _(spark, sf_dir):
    return R.distinct_jobs(jobs(spark, sf_dir))


@query("apply_overrides", f"""WITH {OUTCOMES} SELECT company_clean, role_clean,
    CASE WHEN company_clean = 'customer 000000001' THEN 1 ELSE has_interview END AS has_interview,
    CASE WHEN company_clean IN ('customer 000000001', 'customer 000000002') THEN 0 ELSE is_rejected END AS is_rejected
  FROM outcomes""")
def _(spark, sf_dir):
    fixes = spark.createDataFrame(
        [("Customer 000000001", 1, 0), ("customer 000000002", None, 0)],
        "company_clean string, has_interview int, is_rejected int")
    flags = ("has_interview", "is_rejected")
    return A.apply_overrides(outcomes(spark, sf_dir).select("company_clean", "role_clean", *flags), fixes, flags)


@query("rejections", f"WITH {MAIL} SELECT filename, update_category, notification_type FROM mail WHERE {REJECTED}")
def _(spark, sf_dir):
    return M.rejections(mail(spark, sf_dir)).select("filename", "update_category", "notification_type")


@query("drop_unkeyed", f"WITH {MAIL} SELECT company, role, filename FROM mail WHERE lower(trim(coalesce(company, ''))) NOT IN ('', 'none') AND lower(trim(coalesce(role, ''))) NOT IN ('', 'none')")
def _(spark, sf_dir):
    return M.drop_unkeyed(mail(spark, sf_dir), ("company", "role")).select("company", "role", "filename")


@query("project_mail", f"WITH {MAIL} SELECT role_clean, company_clean, \"date\", update_category, notification_type, is_automated, portal FROM mail")
def _(spark, sf_dir):
    return M.project_mail(mail(spark, sf_dir))


@query("project_saved_jobs", f"WITH {MAIL} SELECT role_clean, company_clean, location, work_type, applied_date FROM jobs")
def _(spark, sf_dir):
    return M.project_saved_jobs(jobs(spark, sf_dir))


@query("project_quick_apply", f"WITH {MAIL} SELECT role_clean, company_clean, applied_date AS linkedin_date FROM jobs")
def _(spark, sf_dir):
    return M.project_quick_apply(jobs(spark, sf_dir).withColumnRenamed("applied_date", "linkedin_date"))


@query("named_tables", f"WITH {MAIL} SELECT m.company_clean, count(*) AS mails FROM mail m JOIN (SELECT DISTINCT company_clean FROM jobs) j ON m.company_clean = j.company_clean GROUP BY m.company_clean")
def _(spark, sf_dir):
    tag = uuid4().hex
    R.register(spark, {f"mail_{tag}": mail(spark, sf_dir), f"jobs_{tag}": jobs(spark, sf_dir)})
    return spark.sql(f"""SELECT m.company_clean, count(*) AS mails FROM mail_{tag} m
        LEFT SEMI JOIN jobs_{tag} j ON m.company_clean = j.company_clean GROUP BY m.company_clean""")
