"""Whole answers: every column and both halves of what other queries show a part of, and texts built to be known."""

from __future__ import annotations

from pyspark.sql import functions as F

from applytrail.functions import dates as D
from applytrail.functions import text as X
from applytrail.operators import enrich as E
from applytrail.operators import mail as M
from applytrail.operators import resolve as V
from applytrail.plans import tracker
from applytrail.sources.scratch import deal
from checks.matches import analysed_mail
from checks.oracle_parts import norm_company, norm_title
from checks.registry import asof, query
from checks.standins import ctes, table
from checks.texts import ANALYSED, FEATURES, FIELDS, analysed

# --- built messages: the page around the text is known, so the text is too -----

PAGE = """'<!DOCTYPE html><html><head><style>p { color: red }</style><title>Offer &amp; more ' || c_custkey || '</title></head><body>' ||
  '<script>var x = "<p>' || c_name || '</p>";</script><p>Dear <b>' || c_name || '</b>,</p><a href="https://x.y/' || c_custkey || '">Apply</a>' ||
  '<!-- ' || c_mktsegment || ' --><div>Nation&nbsp;' || c_nationkey || '<br/>Caf&eacute; &lt;' || c_mktsegment || '&gt;</div>' ||
  CASE WHEN c_custkey % 3 = 0 THEN '<p>   </p><template>' || c_name || '</template>' ELSE '' END || '<p>Bye</p></body></html>'"""


@query("html_text_built", """SELECT c_custkey, 'Offer & more ' || c_custkey || chr(10) || 'Dear' || chr(10) || c_name || chr(10) || ',' || chr(10) ||
  'Nation ' || c_nationkey || chr(10) || 'Cafe <' || c_mktsegment || '>' || chr(10) || 'Bye' AS text FROM customer""")
def _(spark, sf_dir):
    return deal(table(spark, sf_dir, "customer")).select("c_custkey", X.html_to_text(F.expr(PAGE)).alias("text"))


@query("clean_message_built", """SELECT c_custkey, 'Re: cafe ' || c_name || ' now' AS subject, 'See  now' || chr(10) || 'a   b ' || c_mktsegment AS body FROM customer""")
def _(spark, sf_dir):
    raw = deal(table(spark, sf_dir, "customer")).select(
        "c_custkey", F.expr("'  Re: ---- café \t ' || c_name || ' ———— now​'").alias("subject"),
        F.expr("'<p>See https://x.y/' || c_custkey || '/z?q=1 now</p><p>a ----- b ' || c_mktsegment || '</p>'").alias("body"))
    return M.clean_message(raw)


PHRASES = ("We are pleased to offer you the position", "Unfortunately we went with other candidates", "Please take our coding challenge",
           "A short psychometric test awaits you", "Invitation to an interview on Monday", "Please upload your certificate",
           "Thank you for applying to us", "Job alert: ten new roles", "I came across your profile", "Automatic reply: out of office", "Lunch on Friday",
           "Unfortunately the interview was not enough")
CLASSES = (("Job Offer", "Offer"), ("Rejection", "Rejection"), ("Technical Test Request", "Application update"),
           ("Personality Test Request", "Application update"), ("Interview Invitation", "Application update"),
           ("Request for Information", "Application update"), ("Confirmation of Application", "Application update"), ("Job Ad", "Job ad"),
           ("Recruiter Reach-out", "Unknown"), ("Bot/Auto-Reply", "Unrelated"), ("Unknown", "Unknown"), ("Rejection", "Rejection"))
N = len(PHRASES)


def _case(values) -> str:
    return f"CASE event_id % {N} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(values)) + " END"


@query("rule_extractor", f"SELECT event_id, {_case([c for c, _ in CLASSES])} AS category, {_case([t for _, t in CLASSES])} AS type FROM events")
def _(spark, sf_dir):
    phrase = F.expr(_case(PHRASES))
    mail = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 2 == 0, phrase).otherwise(F.lit("Hello")).alias("subject"),
        F.when(F.col("event_id") % 2 == 1, F.upper(phrase)).alias("body"))
    read = M.parse_analysis(E.rule_extractor(mail).select("event_id", "analysis_json"))
    return read.select("event_id", "analysis.category", "analysis.type")


@query("parse_us_date", """SELECT event_id, CASE event_id % 4 WHEN 0 THEN date_trunc('minute', ts::TIMESTAMP) WHEN 1 THEN date_trunc('second', ts::TIMESTAMP)
  WHEN 2 THEN date_trunc('day', ts::TIMESTAMP) END::TIMESTAMP AS parsed FROM events""")
def _(spark, sf_dir):
    ts, style = F.col("ts").cast("timestamp"), F.col("event_id") % 4
    text = F.when(style == 0, F.date_format(ts, "M/d/yy, h:mm a")).when(style == 1, F.date_format(ts, "MM/dd/yyyy HH:mm:ss")).when(
        style == 2, F.date_format(ts, "M/d/yyyy")).otherwise(F.date_format(ts, "yyyy-MM-dd"))
    return table(spark, sf_dir, "events").select("event_id", D.parse_us_date(text).alias("parsed"))


# --- every field ---------------------------------------------------------------

SHOWN_AS = [M.RENAMED_FIELDS.get(f, f) for f in M.ANALYSIS_FIELDS]


def _field(name: str) -> str:
    if name in FIELDS:
        return name
    if name == "urgency":
        return "CASE WHEN readable THEN 'High' END AS urgency"
    return f"NULL::{'BOOLEAN' if name == 'action_required' else 'VARCHAR'} AS {name}"


ALL_FIELDS = ", ".join(_field(f) for f in SHOWN_AS)


@query("parse_analysis_all", f"{ANALYSED} SELECT filename, {ALL_FIELDS}, CASE WHEN NOT readable THEN 'unparseable' END AS error FROM analysed")
def _(spark, sf_dir):
    parsed = analysed(spark, sf_dir)
    return parsed.select("filename", *[F.col("analysis")[f].alias(n) for f, n in zip(M.ANALYSIS_FIELDS, SHOWN_AS, strict=True)], "error")


@query("flatten_analysis_all", f"""{ANALYSED} SELECT filename, "date", "from", "to", subject, cc, body, {ALL_FIELDS}, 'email' AS record_type FROM analysed""")
def _(spark, sf_dir):
    return M.flatten_analysis(analysed(spark, sf_dir))


MAIL_SLUG = f"""substring(md5({norm_company('company')} || '|' || {norm_title('role')} || '|' || strftime("date", '%Y%m%d')), 1, 16)"""


@query("to_application_mail", f"""WITH {ctes('match_mail')}, m AS (SELECT *, {MAIL_SLUG} AS job_id FROM match_mail)
  SELECT job_id || '_' || substring(md5(filename), 1, 8) AS id, 'job_application' AS type, job_id,
    coalesce(nullif(substring({norm_company('company')}, 1, 20), ''), 'unknown') AS "partitionKey", 'email' AS record_type,
    company AS company_name, {norm_company('company')} AS company_normalized, role AS job_title, {norm_title('role')} AS job_title_normalized,
    "date" AS application_date, filename AS email_filename, "date" AS email_date, 'me@home.net' AS email_to, 'hr@firm.example' AS email_from,
    'About ' || role AS email_subject, 'Body' AS email_body_preview, company AS analysis_company_applied_for, role AS analysis_role,
    {', '.join(f"NULL::{'BOOLEAN' if f in M.BOOLEAN_FIELDS else 'INT' if f in M.INTEGER_FIELDS else 'VARCHAR'} AS analysis_{f}"
               for f in M.ANALYSIS_FIELDS if f not in ('company_applied_for', 'role'))},
    NULL::VARCHAR AS linkedin_job_url FROM m""")
def _(spark, sf_dir):
    mail = V.mail_names(analysed_mail(spark, sf_dir))
    named = mail.withColumns({
        "job_id": X.slug(F.col("company"), F.col("role"), F.col("date")), "company_name": F.col("company"),
        "job_title": F.col("role"), "application_date": F.col("date")})
    docs = V.to_application(named, "email", asof())
    return docs.drop("created_at", "updated_at", "linkedin_application_date", "linkedin_company_name", "linkedin_job_title")


# --- the feature table with all its columns --------------------------------------

FLAGS = ("Ask_Python", "Ask_Tableau", "Ask_SQL", "Ask_Linux", "Ask_PowerBI", "Ask_SupplyChain", "Ask_Ind_FinancialServices", "Ask_Ind_URN_977",
         "Ask_Visa_Auth", "Req_Hybrid", "Req_Onsite", "Req_Remote", "Req_Bachelors")
YEARS = ("Req_Years_PowerBI", "Req_Years_SQL", "Req_Years_SupplyChain")
CELLS = ", ".join([f"coalesce(bool_or(feature = '{f}'), FALSE) AS {f}" for f in FLAGS] +
                  [f"max(years) FILTER (WHERE feature = '{f}')::INT AS {f}" for f in YEARS])
EXPORT = "strftime(any_value(o_orderdate), '%-m/%-d/%Y')"


def exports(spark, sf_dir):
    return table(spark, sf_dir, "questions").select(
        F.date_format("o_orderdate", "M/d/yyyy").alias("Application Date"), F.col("o_orderpriority").alias("Company Name"),
        F.lit("Clerk").alias("Job Title"), F.col("o_orderkey").cast("string").alias("Job Url"), F.col("answers").alias("Question And Answers"))


@query("feature_table", f"""{FEATURES}, wide AS (SELECT o_orderkey, {EXPORT} AS "Application_Date", {CELLS} FROM long GROUP BY o_orderkey)
  SELECT wide.* EXCLUDE (o_orderkey), o_orderpriority AS "Company_Name", 'Clerk' AS "Job_Title", o_orderkey::VARCHAR AS "Job_Url"
  FROM wide JOIN questions USING (o_orderkey)""")
def _(spark, sf_dir):
    return tracker.feature_table(exports(spark, sf_dir))


@query("quick_apply_table", f"""{FEATURES}, wide AS (SELECT o_orderkey, {EXPORT} AS linkedin_date, {CELLS} FROM long GROUP BY o_orderkey)
  SELECT wide.* EXCLUDE (o_orderkey), o_orderkey::VARCHAR AS job_url, o_orderpriority AS company, 'Clerk' AS role
  FROM wide JOIN questions USING (o_orderkey)""")
def _(spark, sf_dir):
    """Both halves of the split, joined again on their key."""
    questions, jobs = tracker.quick_apply_table(tracker.feature_table(exports(spark, sf_dir)))
    return questions.join(jobs.select("job_url", "linkedin_date", "company", "role"), "job_url")
