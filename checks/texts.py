"""Queries over text functions, extracted fields, pasted dumps and screening questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from applytrail.functions import dates as D
from applytrail.functions import text as X
from applytrail.operators import enrich as E
from applytrail.operators import mail as M
from applytrail.operators import rows as R
from applytrail.operators import savedjobs as S
from applytrail.operators import screening as Q
from applytrail.plans import tracker
from checks.oracle_parts import NOW, company_clean, norm_company, norm_title, placeholder_null, role_clean
from checks.registry import asof, query
from checks.standins import ctes, table

# --- plain text --------------------------------------------------------------

INVISIBLE = r"[\x{200b}-\x{200f}\x{2028}\x{202a}-\x{202e}\x{2060}-\x{206f}\x{feff}]"


def squeezed(c: str) -> str:
    visible = f"regexp_replace(regexp_replace({c}, '{INVISIBLE}', '', 'g'), '\\x{{a0}}', ' ', 'g')"
    return rf"regexp_replace(regexp_replace({visible}, '[ \t]+', ' ', 'g'), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


@query("squeeze_ws", f"SELECT doc_id, {squeezed('text')} AS clean FROM documents")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.squeeze_ws(F.col("text")).alias("clean"))


@query("ascii_fold", r"SELECT doc_id, regexp_replace(nfc_normalize(strip_accents(text)), '[^\x00-\x7F]', '', 'g') AS clean FROM documents")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.ascii_fold(F.col("text")).alias("clean"))


LINKED = "'Visit ' || url || ' or www.site' || CAST(page_id AS STRING) || '.net/a?b=1 soon.'"


@query("remove_urls", "SELECT page_id, 'Visit  or  soon.' AS clean FROM pages")
def _(spark, sf_dir):
    linked = table(spark, sf_dir, "pages").select("page_id", F.expr(LINKED).alias("linked"))
    return linked.select("page_id", X.remove_urls(F.col("linked")).alias("clean"))


DASHED = "text || ' ---- — ———— -- ' || CAST(doc_id AS STRING) || '-—-'"


@query("strip_dash_runs", rf"""SELECT doc_id, regexp_replace({DASHED}, '[—\-]{{3,}}', '', 'g') AS subject,
  regexp_replace({DASHED}, '[—\-]{{3,}}', ' ', 'g') AS body FROM documents""")
def _(spark, sf_dir):
    dashed = table(spark, sf_dir, "documents").select("doc_id", F.expr(DASHED).alias("d"))
    return dashed.select("doc_id", X.strip_dash_runs(F.col("d"), "").alias("subject"),
                         X.strip_dash_runs(F.col("d"), " ").alias("body"))


@query("html_to_text")
def _(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.html_to_text(F.col("html")).alias("text"))


@query("clean_message")
def _(spark, sf_dir):
    raw = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("Offer ---- "), "url").alias("subject"), F.col("html").alias("body"), "page_id")
    return M.clean_message(raw)


@query("preview", "SELECT doc_id, nullif(substring(text, 1, 600), '') AS preview FROM documents")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.preview(F.col("text")).alias("preview"))


# --- keys --------------------------------------------------------------------

NAMED = """SELECT c_custkey, CASE WHEN c_custkey % 9 = 8 THEN NULL ELSE c_name ||
  CASE c_custkey % 9 WHEN 0 THEN ' Careers Africa' WHEN 1 THEN ' (Pty) Ltd' WHEN 2 THEN ' Holdings Group' WHEN 3 THEN ' SA'
    WHEN 4 THEN ' Inc.' WHEN 5 THEN ' Corp Limited' WHEN 6 THEN ' LLC & Co' ELSE '' END END AS company,
  'Sales/Service_Clerk-' || lower(c_mktsegment) || ' (Remote) [Contract]' AS title,
  'hr@team' || CAST(c_custkey AS STRING) || '.example.com' AS sender,
  CAST(TIMESTAMP '2024-01-01 08:30:00' + INTERVAL '1' HOUR * CAST(c_custkey AS INT) AS TIMESTAMP) AS applied FROM customer"""


def named(spark, sf_dir):
    return spark.sql(NAMED.replace("FROM customer", f"FROM parquet.`{sf_dir}/customer.parquet`"))


@query("norm_company", f"WITH n AS ({NAMED}) SELECT c_custkey, {norm_company('company')} AS norm FROM n")
def _(spark, sf_dir):
    return named(spark, sf_dir).select("c_custkey", X.norm_company(F.col("company")).alias("norm"))


@query("norm_title", f"WITH n AS ({NAMED}) SELECT c_custkey, {norm_title('title')} AS norm FROM n")
def _(spark, sf_dir):
    return named(spark, sf_dir).select("c_custkey", X.norm_title(F.col("title")).alias("norm"))


@query("company_role_clean", f"WITH n AS ({NAMED}) SELECT c_custkey, {company_clean('company')} AS company_clean, {role_clean('title')} AS role_clean FROM n")
def _(spark, sf_dir):
    keyed = M.with_clean_keys(named(spark, sf_dir), "company", "title")
    return keyed.select("c_custkey", "company_clean", "role_clean")


@query("company_or_sender", f"""WITH n AS ({NAMED}) SELECT c_custkey,
  CASE WHEN company IS NULL THEN 'team' || CAST(c_custkey AS VARCHAR) ELSE {company_clean('company', '|group')} END AS company_clean FROM n""")
def _(spark, sf_dir):
    return named(spark, sf_dir).select(
        "c_custkey", X.company_or_sender(F.col("company"), F.col("sender")).alias("company_clean"))


@query("sender_keys", f"""WITH {ctes('mail_rows')} SELECT filename, CASE WHEN company IS NULL
    THEN regexp_extract(lower("from"), '@([^\\.]+)', 1) ELSE {company_clean('company', '|group')} END AS company_clean FROM mail_rows""")
def _(spark, sf_dir):
    return M.with_sender_keys(table(spark, sf_dir, "mail_rows")).select("filename", "company_clean")


SLUG = f"substring(md5({norm_company('company')} || '|' || {norm_title('title')} || '|' || strftime(applied, '%Y%m%d')), 1, 16)"


@query("identifiers", f"""WITH n AS ({NAMED}) SELECT c_custkey, {SLUG} AS slug,
  {SLUG} || '_' || substring(md5(sender), 1, 8) AS email_id,
  md5(coalesce(company, '') || '|' || title || '|' || strftime(applied, '%Y-%m-%dT%H:%M:%S') || '+00:00') AS job_hash,
  coalesce(nullif(substring({norm_company('company')}, 1, 20), ''), 'unknown') AS partition_key,
  CAST(epoch_ms(applied) AS VARCHAR) || '_' || substring(regexp_replace(sender, '[^a-zA-Z0-9]', '_', 'g'), 1, 40) AS message_key
  FROM n""")
def _(spark, sf_dir):
    company, title, applied = F.col("company"), F.col("title"), F.col("applied")
    slug = X.slug(company, title, applied)
    return named(spark, sf_dir).select(
        "c_custkey", slug.alias("slug"), X.email_id(slug, F.col("sender")).alias("email_id"),
        X.job_hash(company, title, applied).alias("job_hash"), X.partition_key(company).alias("partition_key"),
        X.message_key(applied, F.col("sender")).alias("message_key"))


FAMILY_TITLES = """SELECT p_partkey, CASE p_partkey % 10 WHEN 0 THEN 'Senior Data Analyst' WHEN 1 THEN 'AI Engineer'
  WHEN 2 THEN 'Spark developer' WHEN 3 THEN 'Logistics lead' WHEN 4 THEN 'Actuarial intern' WHEN 5 THEN 'Strategy advisor'
  WHEN 6 THEN 'Full-stack dev' WHEN 7 THEN 'Scrum master' WHEN 8 THEN 'Data engineering insight' ELSE p_name END AS title FROM part"""


@query("role_family", f"""WITH t AS ({FAMILY_TITLES}) SELECT p_partkey, CASE p_partkey % 10 WHEN 0 THEN 'Data / Analytics'
  WHEN 1 THEN 'Data Science / ML' WHEN 2 THEN 'Data Engineering' WHEN 3 THEN 'Operations Research' WHEN 4 THEN 'Finance / Quant'
  WHEN 5 THEN 'Consulting / Strategy' WHEN 6 THEN 'Software / Dev' WHEN 7 THEN 'Project / Product' WHEN 8 THEN 'Data / Analytics'
  ELSE NULL END AS family FROM t""")
def _(spark, sf_dir):
    titles = spark.sql(FAMILY_TITLES.replace("FROM part", f"FROM parquet.`{sf_dir}/part.parquet`"))
    return titles.select("p_partkey", X.role_family(F.col("title")).alias("family"))


# --- dates -------------------------------------------------------------------

WRITTEN = """SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, CASE WHEN event_id % 5 = 0 THEN 'iso' WHEN event_id % 5 = 1 THEN 'zone'
  WHEN event_id % 5 = 2 THEN 'mail' WHEN event_id % 5 = 3 THEN 'us' ELSE 'bad' END AS style FROM events"""


@query("parse_mixed_utc", f"""WITH w AS ({WRITTEN}) SELECT event_id, CASE style WHEN 'iso' THEN date_trunc('second', ts)
  WHEN 'zone' THEN date_trunc('second', ts) - INTERVAL 2 HOUR WHEN 'mail' THEN date_trunc('second', ts) + INTERVAL 5 HOUR
  WHEN 'us' THEN date_trunc('minute', ts) END AS utc,
  CASE style WHEN 'iso' THEN date_trunc('second', ts) - INTERVAL 2 HOUR WHEN 'zone' THEN date_trunc('second', ts) - INTERVAL 2 HOUR
  WHEN 'mail' THEN date_trunc('second', ts) + INTERVAL 5 HOUR WHEN 'us' THEN date_trunc('minute', ts) - INTERVAL 2 HOUR END AS board FROM w""")
def _(spark, sf_dir):
    written = spark.sql(WRITTEN.replace("FROM events", f"FROM parquet.`{sf_dir}/events.parquet`"))
    style = F.col("style")
    text = (
        F.when(style == "iso", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(style == "zone", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
        .when(style == "mail", F.concat(F.date_format("ts", "E, d MMM yyyy HH:mm:ss"), F.lit(" -0500 (EST)")))
        .when(style == "us", F.date_format("ts", "M/d/yy, h:mm a")).otherwise(F.lit("next week")))
    return written.withColumn("text", text).select(
        "event_id", D.parse_mixed_utc(F.col("text")).alias("utc"),
        D.parse_mixed(F.col("text"), D.BOARD_ZONE).alias("board"))


# how people, spreadsheets and mail programs write one instant: (format, what is put behind it, what it is cut to, hours to UTC)
DATE_STYLES = (
    ("MMMM d, yyyy", "", "day", 0), ("d MMMM yyyy HH:mm", "", "minute", 0), ("MMM d, yyyy, h:mm a", "", "minute", 0),
    ("yyyy-MM-dd'T'HH:mm", "Z", "minute", 0), ("yyyy-MM-dd'T'HH:mm", "+02:00", "minute", -2), ("d.M.yyyy HH:mm", "", "minute", 0),
    ("yyyy.MM.dd", "", "day", 0), ("E, d MMM yyyy HH:mm:ss.SSS", " +0000", "millisecond", 0), ("E, d MMM yyyy HH:mm:ss", " BST", "second", -1),
    ("d-MMM-yyyy HH:mm:ss", "", "second", 0), ("yyyy/MM/dd HH:mm:ss", "", "second", 0), ("yyyyMMdd'T'HHmmss", "Z", "second", 0),
    ("M/d/yyyy h:mm:ss a", "", "second", 0), ("E MMM d yyyy", "", "day", 0),
)


@query("parse_date_shapes", "SELECT event_id, CASE event_id % " + str(len(DATE_STYLES)) + " " + " ".join(
    f"WHEN {k} THEN date_trunc('{'milliseconds' if unit == 'millisecond' else unit}', ts::TIMESTAMP) + INTERVAL ({hours}) HOUR"
    for k, (_, _, unit, hours) in enumerate(DATE_STYLES)) + " END::TIMESTAMP AS utc FROM events")
def _(spark, sf_dir):
    events, ts = table(spark, sf_dir, "events"), F.col("ts").cast("timestamp")
    written = F.coalesce(*[F.when(F.col("event_id") % len(DATE_STYLES) == k, F.concat(F.date_format(ts, form), F.lit(tail)))
                           for k, (form, tail, _, _) in enumerate(DATE_STYLES)])
    return events.select("event_id", D.parse_mixed_utc(written).alias("utc"))


@query("date_arithmetic", f"""SELECT event_id, abs(floor(date_diff('microsecond', {NOW}, ts::TIMESTAMP) / 86400000000.0))::INT AS floored,
  abs(floor(date_diff('microsecond', ts::TIMESTAMP, {NOW}) / 86400000000.0))::INT AS floored_back,
  datesub('day', ts::TIMESTAMP, {NOW}) AS whole, ts::TIMESTAMP < {NOW} - INTERVAL 21 DAY AS is_old,
  least(ts::TIMESTAMP, TIMESTAMP '2024-01-10') AS first_date, ts::TIMESTAMP - INTERVAL 2 HOUR AS board,
  date_trunc('week', ts)::TIMESTAMP AS week FROM events""")
def _(spark, sf_dir):
    ts, now = F.col("ts"), asof()
    return table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts")).select(
        "event_id", D.days_between_floor(ts, now).alias("floored"), D.days_between_floor(now, ts).alias("floored_back"),
        D.whole_days(now, ts).alias("whole"), D.older_than(ts, now).alias("is_old"),
        D.earliest(ts, F.lit("2024-01-10").cast("timestamp")).alias("first_date"),
        D.assume_zone(ts).alias("board"), D.period(ts, "week").alias("week"))


# --- extracted fields --------------------------------------------------------

READABLE = "event_id % 50 <> 7"


def field(name: str) -> str:
    return f"CASE WHEN json_valid(analysis_json) THEN json_extract_string(analysis_json, '$.{name}') END"


ANALYSED = f"""WITH {ctes('emails')}, raw AS (SELECT *, {field('company_applied_for')} AS c, {field('portal')} AS p, {field('type')} AS t,
    {field('role')} AS r, {field('category')} AS cat, {field('is_automated')} AS auto, {field('test_duration_mins')} AS mins,
    {field('action_type')} AS act FROM emails),
  analysed AS (SELECT filename, "date", "from", "to", subject, cc, body, {placeholder_null('c')} AS company, {placeholder_null('p')} AS portal,
    {placeholder_null('t')} AS notification_type, {placeholder_null('r')} AS role, {placeholder_null('cat')} AS update_category,
    CASE lower(auto) WHEN 'true' THEN TRUE WHEN 'false' THEN FALSE END AS is_automated,
    TRY_CAST(CASE WHEN regexp_matches(mins, '^[+-]?[0-9]+$') THEN mins END AS INT) AS test_duration_mins,
    {placeholder_null('act')} AS action_type, json_valid(analysis_json) AS readable FROM raw)"""

FIELDS = ("company", "portal", "notification_type", "role", "update_category", "is_automated",
          "test_duration_mins", "action_type")


def analysed(spark, sf_dir):
    return M.parse_analysis(table(spark, sf_dir, "emails"))


@query("parse_analysis", f"{ANALYSED} SELECT filename, {', '.join(FIELDS)}, CASE WHEN NOT readable THEN 'unparseable' END AS error FROM analysed")
def _(spark, sf_dir):
    parsed = analysed(spark, sf_dir)
    return parsed.select("filename", *[
        F.col("analysis")[f].alias(M.RENAMED_FIELDS.get(f, f)) for f in M.ANALYSIS_FIELDS
        if M.RENAMED_FIELDS.get(f, f) in FIELDS], "error")


@query("flatten_analysis", f"{ANALYSED} SELECT filename, {', '.join(FIELDS)}, subject, 'email' AS record_type, NULL::VARCHAR AS work_mode FROM analysed")
def _(spark, sf_dir):
    flat = M.flatten_analysis(analysed(spark, sf_dir))
    return flat.select("filename", *FIELDS, "subject", "record_type", "work_mode")


@query("quarantine", f"""{ANALYSED} SELECT filename, CASE WHEN readable THEN 'good' ELSE 'quarantine' END AS side,
  CASE WHEN readable THEN update_category ELSE 'Not Job Related' END AS category FROM analysed""")
def _(spark, sf_dir):
    good, bad = E.split_quarantine(analysed(spark, sf_dir))
    return R.union_sources(*[
        d.select("filename", F.lit(side).alias("side"), F.col("analysis.category").alias("category"))
        for d, side in ((good, "good"), (bad, "quarantine"))])


@query("validate_enums", f"""{ANALYSED} SELECT 'action_type' AS field, action_type AS value, count(*) AS mails FROM analysed
  WHERE action_type NOT IN ('Respond', 'Click Link', 'Schedule Interview', 'Submit Document', 'Take Test', 'Do Nothing') GROUP BY action_type""")
def _(spark, sf_dir):
    return M.validate_enums(analysed(spark, sf_dir))


KEPT = """(notification_type IS NULL OR notification_type NOT IN ('Unrelated', 'Job ad'))"""
EMPTY = """(notification_type = 'Unknown' AND (company IS NULL OR company = 'Unknown') AND role IS NULL
  AND NOT coalesce(is_automated, FALSE) AND portal IS NULL AND action_type IS NULL)"""


@query("drop_unrelated", f"{ANALYSED} SELECT filename, notification_type FROM analysed WHERE {KEPT}")
def _(spark, sf_dir):
    return M.drop_unrelated(M.flatten_analysis(analysed(spark, sf_dir))).select("filename", "notification_type")


@query("drop_empty", f"{ANALYSED} SELECT filename FROM analysed WHERE NOT coalesce({EMPTY}, FALSE)")
def _(spark, sf_dir):
    return M.drop_empty(M.flatten_analysis(analysed(spark, sf_dir))).select("filename")


@query("mail_table", f"""{ANALYSED}, kept AS (SELECT *, nullif(company, 'Unknown') AS named FROM analysed WHERE {KEPT} AND NOT coalesce({EMPTY}, FALSE))
  SELECT split_part(filename, '.', 1) AS uid, CAST("date" AS TIMESTAMP) AS "date", update_category, named AS company, role, is_automated,
    {company_clean('named')} AS company_clean, {role_clean('role')} AS role_clean FROM kept""")
def _(spark, sf_dir):
    return tracker.mail_table(analysed(spark, sf_dir)).select(
        "uid", "date", "update_category", "company", "role", "is_automated", "company_clean", "role_clean")


@query("conform", """SELECT event_id, TRY_CAST(props AS INT) AS props, CAST(value AS INT) AS value FROM events""")
def _(spark, sf_dir):
    rounded = table(spark, sf_dir, "events").select("event_id", "props", F.bround("value", 0).cast("string").alias("value"))
    typed = M.conform(rounded, {"props": "int", "value": "double"})
    return typed.withColumn("value", F.col("value").cast("int"))


@query("scalar_cleanup", f"""WITH {ctes('mail_facts')} SELECT event_id, {placeholder_null('portal')} AS portal,
  CASE lower(trim(replace(automated, '"', ' '))) WHEN 'true' THEN TRUE WHEN 'false' THEN FALSE END AS flag,
  TRY_CAST(replace(minutes, '"', '') AS INT) AS minutes FROM mail_facts""")
def _(spark, sf_dir):
    facts = table(spark, sf_dir, "mail_facts")
    return facts.select(
        "event_id", X.nullify(F.col("portal")).alias("portal"),
        X.clean_bool(F.translate("automated", '"', " ")).alias("flag"),
        X.clean_int(F.translate("minutes", '"', " ")).alias("minutes"))


@query("extractor", f"""WITH {ctes('emails')} SELECT filename, 'Rejection' AS category, length(subject) AS minutes FROM emails""")
def _(spark, sf_dir):
    def extractor(texts):
        subject = texts.str.extract(r"^Email Subject: (.*)\n\nEmail Body: ", expand=False)
        return '{"category": "Rejection", "test_duration_mins": ' + subject.str.len().astype(str) + "}"

    done = E.analyse(table(spark, sf_dir, "emails").drop("analysis_json"), extractor)
    return done.select("filename", F.col("analysis.category").alias("category"),
                       F.col("analysis.test_duration_mins").alias("minutes"))


# --- pasted dumps ------------------------------------------------------------

KEY = "o_orderkey"
UNIT = f"CASE WHEN {KEY} % 4 = 0 THEN 'd' WHEN {KEY} % 4 = 1 THEN 'w' WHEN {KEY} % 4 = 2 THEN 'mo' ELSE 'h' END"
AGE = f"(CAST({KEY} % 50 AS INT) + 1)"
APPLIED = f"""CASE {KEY} % 4 WHEN 0 THEN {NOW} - {AGE} * INTERVAL 1 DAY WHEN 1 THEN {NOW} - {AGE} * INTERVAL 7 DAY
  WHEN 2 THEN {NOW} - {AGE} * INTERVAL 1 MONTH ELSE {NOW} - {AGE} * INTERVAL 1 HOUR END + INTERVAL 1 SECOND"""


@query("saved_jobs", f"""WITH {ctes('dumps')} SELECT {KEY}, 'Clerk ' || {KEY} AS role, c_name AS company, 'City ' || c_nationkey AS location,
    CASE o_orderstatus WHEN 'F' THEN 'Hybrid' WHEN 'P' THEN 'Remote' END AS work_type, {KEY} % 7 <> 0 AS is_open,
    CASE WHEN {KEY} % 7 = 0 THEN 'closed' WHEN {KEY} % 6 = 0 THEN 'reposted' ELSE 'open' END AS listing_status,
    'Applied ' || ({KEY} % 50) || {UNIT} || ' ago' AS raw_applied, {APPLIED} AS applied_date,
    CASE WHEN {KEY} % 6 = 1 THEN 'Posted 3d ago' END AS raw_posted,
    CASE WHEN {KEY} % 6 = 1 THEN {NOW} - INTERVAL 4 DAY + INTERVAL 1 SECOND END AS posted_date,
    CASE WHEN {KEY} % 6 = 0 THEN 'Reposted 2w ago' END AS raw_reposted,
    CASE WHEN {KEY} % 6 = 0 THEN {NOW} - INTERVAL 21 DAY + INTERVAL 1 SECOND END AS reposted_date,
    {KEY} % 7 IN (1, 2) AS app_viewed, {KEY} % 7 = 1 AS resume_downloaded,
    CASE WHEN o_orderstatus = 'F' THEN 'Not moving forward' END AS outcome FROM dumps
  UNION ALL SELECT {KEY}, 'Warden ' || {KEY}, NULL, NULL, NULL, TRUE, 'open', NULL, NULL, NULL, NULL, NULL, NULL, FALSE, FALSE, NULL FROM dumps""")
def _(spark, sf_dir):
    return S.saved_jobs(table(spark, sf_dir, "dumps"), asof(), keep=(KEY,))


BREAK = "chr(10)"
RECORDS = f"""'Clerk ' || {KEY} || ' | ' || c_name || ' | City ' || c_nationkey ||
  CASE o_orderstatus WHEN 'F' THEN ' (Hybrid)' WHEN 'P' THEN ' (REMOTE)' ELSE '' END || ' | Applied ' || ({KEY} % 50) || {UNIT} || ' ago' ||
  CASE WHEN {KEY} % 6 IN (0, 1) THEN ' | ' || CASE {KEY} % 6 WHEN 0 THEN 'Reposted 2w ago' ELSE 'Posted 3d ago' END ||
    CASE WHEN {KEY} % 7 IN (1, 2) THEN ' | ' ELSE {BREAK} END ELSE ' | ' END ||
  CASE {KEY} % 7 WHEN 0 THEN 'No longer accepting applications' || {BREAK} WHEN 1 THEN 'Resume downloaded' || {BREAK}
    WHEN 2 THEN 'Application viewed' || {BREAK} ELSE '' END ||
  CASE o_orderstatus WHEN 'F' THEN 'Not moving forward | ' ELSE '' END || 'Warden ' || {KEY} || ' | Notes Add note'"""


@query("normalise_dump", f"""WITH {ctes('dumps')}, parts AS (SELECT {KEY}, string_split({RECORDS}, {BREAK}) AS records FROM dumps)
  SELECT {KEY}, generate_subscripts(records, 1) - 1 AS line_no, unnest(records) AS record FROM parts""")
def _(spark, sf_dir):
    dumps = table(spark, sf_dir, "dumps").select(KEY, "value")
    return S.dump_records(dumps)


# --- screening questions -----------------------------------------------------

Q1_TOPIC = "CASE o_orderkey % 4 WHEN 0 THEN 'Python' WHEN 1 THEN 'Tableau' WHEN 2 THEN 'SQL' ELSE 'Linux' END"
Q2_TOPIC = "CASE o_orderkey % 5 WHEN 0 THEN 'PowerBI' WHEN 1 THEN 'SQL' WHEN 2 THEN 'SupplyChain' END"
Q2_YEARS = "CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE o_orderkey % 8 END"
INDUSTRY = "CASE o_orderkey % 6 WHEN 0 THEN 'Ind_FinancialServices' WHEN 1 THEN 'Ind_URN_977' END"
FEATURES = f"""WITH {ctes('questions')}, long AS (
  SELECT o_orderkey, o_orderdate, 'Ask_' || {Q1_TOPIC} AS feature, NULL::INT AS years FROM questions
  UNION SELECT o_orderkey, o_orderdate, 'Ask_' || {Q2_TOPIC}, NULL FROM questions WHERE {Q2_TOPIC} IS NOT NULL
  UNION SELECT o_orderkey, o_orderdate, 'Req_Years_' || {Q2_TOPIC}, {Q2_YEARS} FROM questions WHERE {Q2_TOPIC} IS NOT NULL
  UNION SELECT o_orderkey, o_orderdate, 'Ask_' || {INDUSTRY}, NULL FROM questions WHERE {INDUSTRY} IS NOT NULL
  UNION SELECT o_orderkey, o_orderdate, CASE o_orderstatus WHEN 'F' THEN 'Req_Hybrid' WHEN 'P' THEN 'Req_Onsite' ELSE 'Req_Remote' END, NULL FROM questions
  UNION SELECT o_orderkey, o_orderdate, 'Ask_Visa_Auth', NULL FROM questions WHERE o_orderkey % 11 = 0
  UNION SELECT o_orderkey, o_orderdate, 'Req_Bachelors', NULL FROM questions)"""


def asked(spark, sf_dir):
    return Q.with_questions(table(spark, sf_dir, "questions"), "answers").drop("answers")


def featured(spark, sf_dir):
    return Q.with_features(asked(spark, sf_dir)).select("o_orderkey", "o_orderdate", "features")


@query("explode_questions", f"""WITH {ctes('questions')}, parts AS (SELECT o_orderkey, string_split(replace(answers, 'Yes|No', 'Yes~No'), ' | ') AS p FROM questions),
  one AS (SELECT o_orderkey, generate_subscripts(p, 1) AS position, unnest(p) AS f FROM parts)
  SELECT o_orderkey, position, trim(substring(f, 1, instr(f, ':') - 1)) AS question,
    replace(trim(substring(f, instr(f, ':') + 1)), 'Yes~No', 'Yes|No') AS answer FROM one""")
def _(spark, sf_dir):
    return Q.explode_questions(asked(spark, sf_dir).select("o_orderkey", "questions"))


@query("drop_admin_questions", f"""WITH {ctes('questions')} SELECT o_orderkey, 4 + CAST(o_orderkey % 11 = 0 AS INT) + CAST(o_orderkey % 6 IN (0, 1) AS INT)
  AS questions FROM questions""")
def _(spark, sf_dir):
    kept = Q.drop_admin_questions(Q.explode_questions(asked(spark, sf_dir).select("o_orderkey", "questions")))
    return kept.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("questions"))


@query("tag_topics", f"""WITH {ctes('questions')}, tags AS (
    SELECT o_orderkey, {Q1_TOPIC} AS topic, NULL AS required_years FROM questions
    UNION ALL SELECT o_orderkey, {Q2_TOPIC}, {Q2_YEARS} FROM questions
    UNION ALL SELECT o_orderkey, {INDUSTRY}, NULL FROM questions)
  SELECT topic, required_years, count(*) AS questions FROM tags WHERE topic IS NOT NULL GROUP BY ALL""")
def _(spark, sf_dir):
    tagged = Q.tag_topics(asked(spark, sf_dir).select("o_orderkey", "questions"))
    exploded = tagged.select(F.explode("topics").alias("topic"), "required_years")
    return exploded.groupBy("topic", "required_years").agg(F.count(F.lit(1)).alias("questions"))


@query("long_features", f"{FEATURES} SELECT o_orderkey, feature, years FROM long")
def _(spark, sf_dir):
    return Q.long_features(featured(spark, sf_dir)).drop("o_orderdate")


SHOWN = ("Ask_Python", "Ask_SQL", "Ask_PowerBI", "Ask_SupplyChain", "Ask_Ind_FinancialServices", "Ask_Ind_URN_977",
         "Req_Hybrid", "Req_Remote", "Req_Onsite", "Ask_Visa_Auth", "Req_Bachelors", "Req_Masters")
YEARS = ("Req_Years_SQL", "Req_Years_PowerBI", "Req_Years_SupplyChain")


@query("feature_matrix", f"""{FEATURES} SELECT o_orderkey, {', '.join(f"coalesce(bool_or(feature = '{f}'), FALSE) AS {f}" for f in SHOWN)},
  {', '.join(f"max(years) FILTER (WHERE feature = '{f}')::INT AS {f}" for f in YEARS)} FROM long GROUP BY o_orderkey""")
def _(spark, sf_dir):
    return Q.fill_flags(Q.feature_matrix(featured(spark, sf_dir), [*SHOWN, *YEARS]).drop("o_orderdate"))


@query("drop_sparse", f"""{FEATURES} SELECT o_orderkey, {', '.join(f"coalesce(bool_or(feature = '{f}'), FALSE) AS {f}" for f in SHOWN if f != 'Req_Masters')}
  FROM long GROUP BY o_orderkey""")
def _(spark, sf_dir):
    wide = Q.feature_matrix(featured(spark, sf_dir), list(SHOWN)).drop("o_orderdate")
    return Q.fill_flags(Q.drop_sparse(wide, list(SHOWN)))


@query("feature_names", f"{FEATURES} SELECT feature, count(*) AS applications FROM long GROUP BY feature HAVING count(*) >= 2")
def _(spark, sf_dir):
    return Q.feature_names(Q.long_features(featured(spark, sf_dir)))


@query("skill_frequency", f"{FEATURES} SELECT substring(feature, 5) AS topic, count(*) AS applications FROM long WHERE feature LIKE 'Ask!_%' ESCAPE '!' GROUP BY ALL")
def _(spark, sf_dir):
    return Q.skill_frequency(Q.long_features(featured(spark, sf_dir)))


@query("skill_by_month", f"""{FEATURES} SELECT substring(feature, 5) AS topic, date_trunc('month', o_orderdate)::TIMESTAMP AS month,
  count(*) AS applications FROM long WHERE feature LIKE 'Ask!_%' ESCAPE '!' GROUP BY ALL""")
def _(spark, sf_dir):
    return Q.skill_by_month(Q.long_features(featured(spark, sf_dir)), "o_orderdate")


@query("split_by_prefix", f"""{FEATURES} SELECT o_orderkey AS job_key, coalesce(bool_or(feature = 'Ask_SQL'), FALSE) AS Ask_SQL FROM long GROUP BY o_orderkey""")
def _(spark, sf_dir):
    wide = Q.fill_flags(Q.feature_matrix(featured(spark, sf_dir), ["Ask_SQL"]))
    questions, _ = M.split_by_prefix(wide, ("Ask_", "Req_"), [F.col("o_orderkey").alias("job_key")])
    return questions
