"""Job-tracking inputs derived from the driver tables.

The tables hold no mail or job data, so each input is a projection of them. The text
below is plain SQL that both Spark and DuckDB read: the queries start from it through
``table``, the oracles through ``ctes``. It only shapes inputs; what the operators do
with them is written separately on each side.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from applytrail.sources.scratch import tasks_for

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "pages", "conversations",
)

SYLLABLES = "ka,ven,tor,mil,sol,dra,pen,lux,rho,bex,nim,cor,tav,gel,fos,wyn,zed,hap,qui,jor,ast,elm,oba,urd,ips"
TITLES = (
    "data analyst,senior data analyst,data engineer,software engineer,sales manager,office manager,"
    "machine learning engineer,risk analyst,product owner,supply chain planner,nurse,teacher"
)


def _syllable(n: str) -> str:
    return f"split_part('{SYLLABLES}', ',', CAST({n} % 25 AS INT) + 1)"


def company(n: str) -> str:
    """A pronounceable company name for key ``n``; different keys differ."""
    high = [f"CAST(floor({n} / {25 ** i}) AS BIGINT)" for i in (1, 2, 3)]
    return (
        f"{_syllable(n)} || {_syllable(high[0])} || ' ' || {_syllable(high[1])} || {_syllable(high[2])} || ' works'"
    )


def title(n: str) -> str:
    return f"split_part('{TITLES}', ',', CAST({n} % 12 AS INT) + 1)"


K = "CAST(substring(props, 7, length(props) - 7) AS INT)"

MAIL_FACTS = f"""
SELECT event_id, user_id, event_type, value, CAST(ts AS TIMESTAMP) AS ts, {K} AS k,
  CASE WHEN {K} % 10 = 0 THEN 'None' WHEN {K} % 10 = 1 THEN 'Unknown'
       ELSE 'Customer#' || lpad(CAST(user_id AS STRING), 9, '0') ||
            CASE WHEN {K} % 3 = 0 THEN ' Ltd' WHEN {K} % 3 = 1 THEN ', Inc.' ELSE '' END END AS raw_company,
  CASE WHEN {K} % 25 = 3 THEN 'n/a' ELSE 'Role-' || CAST(event_id % 7 AS STRING) || ' (Remote)' END AS raw_role,
  CASE event_type WHEN 'signup' THEN 'Confirmation of Application' WHEN 'click' THEN 'Technical Test Request'
       WHEN 'view' THEN 'Interview Invitation' WHEN 'error' THEN 'Rejection'
       ELSE 'Personality Test Request' END AS category,
  CASE WHEN event_type = 'error' THEN 'Rejection' WHEN {K} % 20 = 1 THEN 'Unrelated' WHEN {K} % 20 = 2 THEN 'Job ad'
       WHEN {K} % 10 = 0 THEN 'Unknown' WHEN {K} % 20 = 5 THEN '' ELSE 'Application update' END AS type,
  CASE WHEN {K} % 4 = 0 THEN 'true' WHEN {K} % 4 = 1 THEN 'false' WHEN {K} % 4 = 2 THEN '"False"' ELSE 'null' END AS automated,
  CASE WHEN {K} % 5 = 0 THEN '"ninety"' WHEN {K} % 5 = 1 THEN '"' || CAST({K} AS STRING) || '"'
       WHEN {K} % 5 = 2 THEN CAST({K} AS STRING) ELSE 'null' END AS minutes,
  CASE WHEN {K} % 10 = 0 THEN 'None' ELSE 'Portal ' || CAST({K} % 4 AS STRING) END AS portal,
  CASE WHEN {K} % 10 = 0 THEN '' WHEN {K} % 6 = 1 THEN 'Dance' ELSE 'Respond' END AS action
FROM events
"""

EMAILS = """
SELECT event_id, ts, 'mail_' || CAST(event_id AS STRING) || '.v1.json' AS filename,
  'me@home.net' AS "to", 'Jobs <hr@firm' || CAST(user_id AS STRING) || '.example.com>' AS "from",
  'Your application ' || CAST(event_id AS STRING) AS subject, '' AS cc,
  CAST(ts AS STRING) AS "date", 'Body of ' || CAST(event_id AS STRING) AS body,
  CASE WHEN event_id % 50 = 7 THEN '{"company_applied_for": "cut o'
  ELSE '{"company_applied_for": "' || raw_company || '", "portal": "' || portal || '", "type": "' || type ||
       '", "role": "' || raw_role || '", "category": "' || category || '", "is_automated": ' || automated ||
       ', "test_duration_mins": ' || minutes || ', "action_type": "' || action || '", "urgency": "High"}'
  END AS analysis_json
FROM mail_facts
"""

# mail table and saved-jobs table, keys not yet cleaned
MAIL_ROWS = """
SELECT 'mail_' || CAST(event_id AS STRING) AS filename, event_id, ts AS "date",
  CASE WHEN raw_company IN ('None', 'Unknown') THEN NULL ELSE raw_company END AS company,
  CASE WHEN raw_role = 'n/a' THEN NULL ELSE raw_role END AS role,
  category AS update_category, type AS notification_type,
  CASE automated WHEN 'true' THEN TRUE WHEN 'null' THEN NULL ELSE FALSE END AS is_automated,
  portal, action AS action_type, 'Jobs <hr@Firm' || CAST(user_id AS STRING) || '.example.com>' AS "from"
FROM mail_facts
"""

JOB_ROWS = """
SELECT o_orderkey, c_name || CASE WHEN o_orderkey % 3 = 0 THEN ' Limited' ELSE '' END AS company,
  'Role ' || CAST(o_orderkey % 7 AS STRING) AS role,
  CAST(TIMESTAMP '2023-12-15 09:00:00' + INTERVAL '1' DAY * CAST(o_orderkey % 40 AS INT) AS TIMESTAMP) AS applied_date,
  CASE o_orderstatus WHEN 'F' THEN 'Not moving forward' WHEN 'P' THEN 'Interview' ELSE NULL END AS outcome,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN 'Remote'
       WHEN o_orderkey % 5 = 2 THEN 'Hybrid' ELSE 'On-site' END AS work_type,
  'City ' || CAST(c_nationkey AS STRING) AS location
FROM orders JOIN customer ON o_custkey = c_custkey
"""

DUMPS = """
SELECT o_orderkey, o_orderstatus, c_name, c_nationkey,
  '0 notifications' || chr(10) || 'Saved 3' || chr(10) || 'Clerk ' || CAST(o_orderkey AS STRING) || chr(10) ||
  c_name || ' · City ' || CAST(c_nationkey AS STRING) ||
    CASE o_orderstatus WHEN 'F' THEN ' (Hybrid)' WHEN 'P' THEN ' (REMOTE)' ELSE '' END || chr(10) ||
  'Applied ' || CAST(o_orderkey % 50 AS STRING) ||
    CASE WHEN o_orderkey % 4 = 0 THEN 'd' WHEN o_orderkey % 4 = 1 THEN 'w' WHEN o_orderkey % 4 = 2 THEN 'mo' ELSE 'h' END
    || ' ago' || chr(10) ||
  CASE WHEN o_orderkey % 6 = 0 THEN 'Reposted 2w ago' || chr(10) WHEN o_orderkey % 6 = 1 THEN 'Posted 3d ago' || chr(10)
       ELSE '' END ||
  CASE WHEN o_orderkey % 7 = 0 THEN 'No longer accepting applications' || chr(10)
       WHEN o_orderkey % 7 = 1 THEN 'Resume downloaded' || chr(10) WHEN o_orderkey % 7 = 2 THEN 'Application viewed' || chr(10)
       ELSE '' END ||
  CASE WHEN o_orderstatus = 'F' THEN 'Not moving forward' || chr(10) ELSE '' END ||
  'Notes' || chr(10) || 'Add note' || chr(10) ||
  'Warden ' || CAST(o_orderkey AS STRING) || chr(10) || 'Notes Add note' || chr(10) || 'Next' AS value
FROM (SELECT *, 'Customer#' || lpad(CAST(o_custkey AS STRING), 9, '0') AS c_name, o_custkey % 25 AS c_nationkey FROM orders)
"""

QUESTIONS = """
SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate, o_orderpriority, o_orderstatus,
  'How many years of experience with ' ||
    CASE WHEN o_orderkey % 4 = 0 THEN 'Python' WHEN o_orderkey % 4 = 1 THEN 'Tableau' WHEN o_orderkey % 4 = 2 THEN 'SQL' ELSE 'Ubuntu' END
    || ' do you have?: ' || CAST(o_orderkey % 9 AS STRING) || ' | ' ||
  'At least ' || CASE WHEN o_orderkey % 3 = 0 THEN 'five' ELSE CAST(o_orderkey % 8 AS STRING) || '+' END || ' years of ' ||
    CASE WHEN o_orderkey % 5 = 0 THEN 'Power BI' WHEN o_orderkey % 5 = 1 THEN 'MySQL' WHEN o_orderkey % 5 = 2 THEN 'logistics' ELSE 'embroidery' END
    || '?: Yes|No | ' ||
  'First name: Ann | Email address: a@b.c | ' ||
  CASE o_orderstatus WHEN 'F' THEN 'Hybrid or remote?: Remote' WHEN 'P' THEN 'Can you work onsite?: Yes' ELSE 'Remote ok?: No' END || ' | ' ||
  CASE WHEN o_orderkey % 11 = 0 THEN 'Need visa sponsorship?: No | ' ELSE '' END ||
  CASE WHEN o_orderkey % 6 = 0 THEN 'Industry experience: urn:li:industry:43 | ' WHEN o_orderkey % 6 = 1 THEN 'Industry experience: urn:li:industry:977 | ' ELSE '' END ||
  'Completed a Bachelor or Master degree?: Yes' AS answers
FROM orders
"""

# names for matching: mails misspell or extend the company, titles repeat
MATCH_MAIL = f"""
SELECT 'mail_' || CAST(event_id AS STRING) AS filename,
  CASE WHEN {K} % 4 = 0 THEN {company("user_id")} || ' Ltd'
       WHEN {K} % 4 = 1 THEN substring({company("user_id")}, 2, 60)
       ELSE {company("user_id")} END AS company,
  CASE WHEN {K} % 7 = 0 THEN 'jr ' || {title("event_id")} ELSE {title("event_id")} END AS role,
  CAST(ts AS TIMESTAMP) AS "date"
FROM events
"""

MATCH_JOBS = f"""
SELECT 'job_' || lpad(CAST(o_orderkey AS STRING), 12, '0') AS job_ref,
  {company("o_custkey")} || CASE WHEN o_orderkey % 3 = 0 THEN ' (Pty) Ltd' ELSE '' END AS company_name,
  {title("o_orderkey")} AS job_title,
  CAST(CAST(o_orderdate AS TIMESTAMP) + INTERVAL '24' YEAR + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT) AS TIMESTAMP) AS application_date,
  'https://board.example/' || CAST(o_orderkey AS STRING) AS job_url
FROM orders
"""

# name -> (SQL, stand-ins it reads)
STANDINS = {
    "mail_facts": MAIL_FACTS,
    "emails": EMAILS,
    "mail_rows": MAIL_ROWS,
    "job_rows": JOB_ROWS,
    "dumps": DUMPS,
    "questions": QUESTIONS,
    "match_mail": MATCH_MAIL,
    "match_jobs": MATCH_JOBS,
}
# one driver table each, and heavy work per row ahead
SCAN_ONLY = ("emails", "dumps", "questions", "match_mail", "match_jobs")
NEEDS = {"emails": ("mail_facts",), "mail_rows": ("mail_facts",)}


def _spark_text(sql: str) -> str:
    return sql.replace('"to"', "`to`").replace('"from"', "`from`").replace('"date"', "`date`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table or stand-in. Instants without a zone are taken as UTC."""
    if name not in STANDINS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spark.sql(_inlined(spark, name, sf_dir, name in SCAN_ONLY))


def _inlined(spark: SparkSession, name: str, sf_dir: str, dealt: bool) -> str:
    """A stand-in's text over its files; if ``dealt``, the rows go to as many tasks as they need, before any text is built."""
    sql = _spark_text(STANDINS[name])
    for other in NEEDS.get(name, ()):
        sql = sql.replace(f"FROM {other}\n", f"FROM ({_inlined(spark, other, sf_dir, dealt)})\n")
    for t in DRIVER_TABLES:
        if dealt and re.search(rf"\bFROM {t}\b", sql):
            tasks = tasks_for(spark.read.parquet(f"{sf_dir}/{t}.parquet"))
            sql = re.sub(rf"\bFROM {t}\b", f"FROM (SELECT /*+ REPARTITION({tasks}) */ * FROM parquet.`{sf_dir}/{t}.parquet`)", sql)
        for word in ("FROM", "JOIN"):
            sql = re.sub(rf"\b{word} {t}\b", f"{word} parquet.`{sf_dir}/{t}.parquet`", sql)
    return sql


def ctes(*names: str) -> str:
    """The stand-ins as the head of a DuckDB ``WITH`` clause."""
    wanted: list[str] = []
    for name in names:
        wanted += [n for n in (*NEEDS.get(name, ()), name) if n not in wanted]
    return ", ".join(f"{n} AS ({STANDINS[n]})" for n in wanted)
