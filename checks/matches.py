"""Queries over fuzzy matching, resolution and the store."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from applytrail.functions import text as X
from applytrail.functions.similarity import similarity
from applytrail.operators import matching as G
from applytrail.operators import resolve as V
from applytrail.operators import rows as R
from applytrail.operators import screening as Q
from applytrail.sources import readers, sinks
from applytrail.sources.scratch import shared_folder
from checks.oracle_parts import lcs_ratio, norm_company, norm_title
from checks.registry import asof, query
from checks.standins import ctes, table


@query("similarity", f"""WITH p AS (SELECT DISTINCT p_name || ' ' || p_brand AS a, p_type || ' ' || p_name AS b FROM part)
  SELECT a, b, {lcs_ratio('a', 'b')} AS ratio FROM p""")
def _(spark, sf_dir):
    pairs = table(spark, sf_dir, "part").select(
        F.concat_ws(" ", "p_name", "p_brand").alias("a"), F.concat_ws(" ", "p_type", "p_name").alias("b")).distinct()
    return pairs.withColumn("ratio", similarity(F.col("a"), F.col("b")))


DAYS = "abs(floor(date_diff('microsecond', j.application_date, m.\"date\") / 86400000000.0))::INT"
NAMED = f"""{ctes('match_mail', 'match_jobs')},
m AS (SELECT *, {norm_company('company')} AS nc, {norm_title('role')} AS nt FROM match_mail),
j AS (SELECT *, {norm_company('company_name')} AS nc, {norm_title('job_title')} AS nt FROM match_jobs)"""


@query("match_candidates", f"""WITH {NAMED} SELECT filename, count(*) AS candidates, sum(days_diff)::BIGINT AS days FROM (
    SELECT filename, {DAYS} AS days_diff FROM m JOIN j ON j.application_date > m."date" - INTERVAL 12 DAY
      AND j.application_date < m."date" + INTERVAL 12 DAY) WHERE days_diff <= 10 GROUP BY filename""")
def _(spark, sf_dir):
    """Pairs of distinct instants, which stand for those of all their mails and jobs; a job's instant carries its jobs."""
    mail = table(spark, sf_dir, "match_mail")
    instants = table(spark, sf_dir, "match_jobs").groupBy("application_date").agg(F.count(F.lit(1)).alias("jobs"))
    pairs = G.match_candidates(mail.select("date").distinct(), instants)
    reached = pairs.groupBy("date").agg(F.sum("jobs").alias("candidates"), F.sum(F.col("jobs") * F.col("days_diff")).alias("days"))
    return mail.select("filename", "date").join(reached, "date").groupBy("filename").agg(
        F.sum("candidates").alias("candidates"), F.sum("days").alias("days"))


# each mail against the orders of its own customer: many pairs, few distinct names
PAIRED = f"""{NAMED}, pairs AS (SELECT e.event_id, o.o_orderkey, m.nc AS a, j.nc AS b, m.nt AS c, j.nt AS d, {DAYS} AS days_diff
  FROM events e JOIN orders o ON e.user_id = o.o_custkey JOIN m ON m.filename = 'mail_' || e.event_id
  JOIN j ON j.job_ref = 'job_' || lpad(CAST(o.o_orderkey AS VARCHAR), 12, '0')),
cs AS (SELECT a, b, {lcs_ratio('a', 'b')} AS cr FROM (SELECT DISTINCT a, b FROM pairs)),
ts AS (SELECT c, d, {lcs_ratio('c', 'd')} AS tr FROM (SELECT DISTINCT c, d FROM pairs))"""


@query("match_score", f"""WITH {PAIRED} SELECT event_id, o_orderkey, days_diff,
    cr * 0.45::DOUBLE + tr * 0.45::DOUBLE + greatest(0.0::DOUBLE, 1.0::DOUBLE - days_diff / 5.0::DOUBLE) * 0.1::DOUBLE AS score,
    greatest(0.0::DOUBLE, 1.0::DOUBLE - days_diff / 5.0::DOUBLE) > 0 AS dated
  FROM pairs JOIN cs USING (a, b) JOIN ts USING (c, d)""")
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.concat(F.lit("mail_"), F.col("event_id").cast("string")).alias("filename"))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey",
        F.concat(F.lit("job_"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("job_ref"))
    pairs = (
        events.join(orders, F.col("user_id") == F.col("o_custkey"))
        .join(table(spark, sf_dir, "match_mail"), "filename").join(table(spark, sf_dir, "match_jobs"), "job_ref")
    )
    return G.match_score(pairs).select(
        "event_id", "o_orderkey", "days_diff", "score", (F.col("date_score") > 0).alias("dated"))


SCORE = "cr * 0.45::DOUBLE + tr * 0.45::DOUBLE + greatest(0.0::DOUBLE, 1.0::DOUBLE - days_diff / 5.0::DOUBLE) * 0.1::DOUBLE"
RATIOS = f"""cs AS (SELECT a, b, {lcs_ratio('a', 'b')} AS cr FROM (SELECT DISTINCT nc AS a FROM m), (SELECT DISTINCT nc AS b FROM j)),
ts AS (SELECT c, d, {lcs_ratio('c', 'd')} AS tr FROM (SELECT DISTINCT nt AS c FROM m), (SELECT DISTINCT nt AS d FROM j))"""


@query("best_match", f"""WITH {NAMED}, {RATIOS},
  near AS (SELECT m.filename, m.nc AS a, j.nc AS b, m.nt AS c, j.nt AS d, job_ref, {DAYS} AS days_diff FROM m JOIN j
    ON j.application_date > m."date" - INTERVAL 12 DAY AND j.application_date < m."date" + INTERVAL 12 DAY),
  scored AS (SELECT filename, job_ref, cr, tr, {SCORE} AS score FROM near JOIN cs USING (a, b) JOIN ts USING (c, d) WHERE days_diff <= 10)
  SELECT filename, job_ref, score, cr AS company_score, tr AS title_score FROM scored WHERE score >= 0.72
  QUALIFY row_number() OVER (PARTITION BY filename ORDER BY score DESC, job_ref) = 1""")
def _(spark, sf_dir):
    return G.best_match(table(spark, sf_dir, "match_mail"), table(spark, sf_dir, "match_jobs"), "job_ref", 10)


def stored_docs(spark, sf_dir):
    """Applications of the older half of the board, as an earlier run left them."""
    board = V.board_jobs(table(spark, sf_dir, "match_jobs").drop("job_ref"))
    older = board.filter(F.col("application_date") < F.lit("2022-06-01").cast("timestamp"))
    docs = V.to_application(older, "linkedin", F.lit("2023-01-01").cast("timestamp"))
    return R.last_per_key(docs, "id", ("linkedin_job_url",))


def analysed_mail(spark, sf_dir):
    m = table(spark, sf_dir, "match_mail")
    none = F.lit(None)
    from applytrail.operators.mail import ANALYSIS_FIELDS, BOOLEAN_FIELDS, INTEGER_FIELDS
    known = {"company_applied_for": F.col("company"), "role": F.col("role")}
    types = {**dict.fromkeys(BOOLEAN_FIELDS, "boolean"), **dict.fromkeys(INTEGER_FIELDS, "int")}
    fields = [known.get(f, none.cast(types.get(f, "string"))).alias(f) for f in ANALYSIS_FIELDS]
    return m.select(
        "filename", F.lit("me@home.net").alias("to"), F.lit("hr@firm.example").alias("from"),
        F.concat(F.lit("About "), "role").alias("subject"), "date", F.lit("Body").alias("body"),
        F.struct(*fields).alias("analysis"))


@query("resolve")
def _(spark, sf_dir):
    jobs = table(spark, sf_dir, "match_jobs").drop("job_ref")
    return V.resolve(analysed_mail(spark, sf_dir), jobs, stored_docs(spark, sf_dir), asof())


SLUG = f"substring(md5({norm_company('company_name')} || '|' || {norm_title('job_title')} || '|' || strftime(application_date, '%Y%m%d')), 1, 16)"
BOARD = f"""{ctes('match_jobs')}, board AS (SELECT *, {SLUG} AS job_id, md5(company_name || '|' || job_title || '|' ||
  strftime(application_date, '%Y-%m-%dT%H:%M:%S') || '+00:00') AS job_hash FROM match_jobs)"""


# the best stored application at any distance in time; names meet first, and only those that can reach the threshold meet records
STORED = f"""WITH {NAMED}, {RATIOS},
  slugged AS (SELECT *, {SLUG} AS job_id FROM j),
  stored AS (SELECT * FROM slugged QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY job_url DESC) = 1),
  names AS (SELECT nc, nt, b, d, cr, tr FROM (SELECT DISTINCT nc, nt FROM m) JOIN cs ON nc = a AND cr >= 0.377 JOIN ts ON nt = c AND tr >= 1.377 - cr)"""


@query("match_store", f"""{STORED},
  scored AS (SELECT filename, job_id, cr, tr, {DAYS.replace('j.', 's.')} AS days_diff, {SCORE} AS score
    FROM m JOIN names n ON m.nc = n.nc AND m.nt = n.nt JOIN stored s ON s.nc = n.b AND s.nt = n.d)
  SELECT filename, job_id, score, cr AS company_score, tr AS title_score FROM scored WHERE score >= 0.72
  QUALIFY row_number() OVER (PARTITION BY filename ORDER BY score DESC, job_id) = 1""")
def _(spark, sf_dir):
    board = V.board_jobs(table(spark, sf_dir, "match_jobs").drop("job_ref"))
    # one record per job, as a store holds them
    stored = R.last_per_key(V.to_application(board, "linkedin", asof()), "id", ("linkedin_job_url",))
    return V.match_store(table(spark, sf_dir, "match_mail"), stored)


@query("to_application", f"""WITH {BOARD} SELECT job_id || '_linkedin' AS id, 'job_application' AS type, job_id,
    coalesce(nullif(substring({norm_company('company_name')}, 1, 20), ''), 'unknown') AS "partitionKey", 'linkedin' AS record_type,
    company_name, {norm_company('company_name')} AS company_normalized, job_title, {norm_title('job_title')} AS job_title_normalized,
    application_date, job_url AS linkedin_job_url, application_date AS linkedin_application_date FROM board""")
def _(spark, sf_dir):
    board = V.board_jobs(table(spark, sf_dir, "match_jobs").drop("job_ref"))
    return V.to_application(board, "linkedin", asof()).select(
        "id", "type", "job_id", "partitionKey", "record_type", "company_name", "company_normalized", "job_title",
        "job_title_normalized", "application_date", "linkedin_job_url", "linkedin_application_date")


@query("unmatched_jobs", f"""WITH {BOARD} SELECT job_id, min(job_hash || '|' || job_url) AS job_ref FROM board
  WHERE job_hash NOT IN (SELECT job_hash FROM board WHERE application_date >= TIMESTAMP '2024-01-01')
    AND job_id NOT IN (SELECT job_id FROM board WHERE application_date < TIMESTAMP '2021-01-01') GROUP BY job_id""")
def _(spark, sf_dir):
    board = V.board_jobs(table(spark, sf_dir, "match_jobs").drop("job_ref"))
    matched = board.filter(F.col("application_date") >= F.lit("2024-01-01").cast("timestamp"))
    known = board.filter(F.col("application_date") < F.lit("2021-01-01").cast("timestamp"))
    return V.unmatched_jobs(board, matched, known).select("job_id", "job_ref")


# every board row, those of a job exported more than once too: its master is the row of the smallest job_ref
@query("inherit_board_fields", f"""WITH {BOARD} SELECT o_orderkey AS n, job_id,
    first_value(job_url) OVER (PARTITION BY job_id ORDER BY job_hash || '|' || job_url) AS linkedin_job_url
  FROM board JOIN orders ON job_ref = 'job_' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0')""")
def _(spark, sf_dir):
    board = V.board_jobs(table(spark, sf_dir, "match_jobs").drop("job_ref"))
    docs = board.select(
        F.substring_index("linkedin_job_url", "/", -1).cast("long").alias("n"), "job_id",
        F.lit(None).cast("string").alias("linkedin_job_url"))
    return V.inherit_board_fields(docs, board.select("job_id", "job_ref", "linkedin_job_url"))


@query("orphan_leaders", f"""WITH {NAMED}, dated AS (SELECT *, CASE WHEN nc = '' OR nt = '' THEN strftime("date", '%Y%m%d') ELSE '' END AS day FROM m),
  first AS (SELECT nc, nt, day, arg_min(company, ("date", filename)) AS company,
    arg_min(role, ("date", filename)) AS role, min("date") AS d FROM dated GROUP BY nc, nt, day)
  SELECT filename, first.company AS company_name, first.role AS job_title, d AS application_date
  FROM dated JOIN first USING (nc, nt, day)""")
def _(spark, sf_dir):
    led = V.orphan_leaders(table(spark, sf_dir, "match_mail"))
    return led.select("filename", "company_name", "job_title", "application_date")


@query("prefix_columns", """SELECT o_orderkey, o_orderstatus AS linkedin_order_status, o_totalprice AS linkedin_total_price_ FROM orders""")
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnsRenamed(
        {"o_orderstatus": "Order Status", "o_totalprice": "Total Price!"})
    chosen = orders.select("o_orderkey", "Order Status", "Total Price!")
    return chosen.select("o_orderkey", *V.prefix_columns(chosen, skip=("o_orderkey",)))


# --- store and files ---------------------------------------------------------

# an older and a newer state of the same records: the newer half replaces what it repeats
OLD = "SELECT o_orderkey AS id, 'job_application' AS type, o_orderstatus AS status, TIMESTAMP '2024-01-01' AS created_at FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'"
NEW = "SELECT o_orderkey AS id, 'job_application' AS type, 'N' AS status, TIMESTAMP '2024-02-01' AS created_at FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'"
UPSERTED = f"""WITH o AS ({OLD}), n AS ({NEW}) SELECT coalesce(n.id, o.id) AS id, 'job_application' AS type, coalesce(n.status, o.status) AS status,
  coalesce(o.created_at, n.created_at) AS created_at FROM o FULL OUTER JOIN n ON o.id = n.id"""


def _states(spark, sf_dir):
    return [spark.sql(s.replace("FROM orders", f"FROM parquet.`{sf_dir}/orders.parquet`")) for s in (OLD, NEW)]


@query("upsert", UPSERTED)
def _(spark, sf_dir):
    return V.upsert(*_states(spark, sf_dir))


@query("store_upsert_read", UPSERTED)
def _(spark, sf_dir):
    old, new = _states(spark, sf_dir)
    path = f"{shared_folder(spark)}/store-{uuid4().hex}"
    sinks.write_upsert(spark, path, old)
    sinks.compact(spark, path)
    sinks.write_upsert(spark, path, new)
    sinks.write_upsert(spark, path, new)
    return sinks.read_store(spark, path)


@query("sync_missing", "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'")
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    done = orders.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    return readers.sync_missing(orders.select("o_orderkey"), done, "o_orderkey")


@query("applications_csv", f"""WITH {ctes('questions')} SELECT o_orderpriority AS "Company Name", count(*) AS applications,
  sum(length(answers))::BIGINT AS answered FROM questions GROUP BY ALL""")
def _(spark, sf_dir):
    folder = f"{shared_folder(spark)}/exports-{uuid4().hex}"
    exports = table(spark, sf_dir, "questions").select(
        F.date_format("o_orderdate", "M/d/yy, h:mm a").alias("Application Date"),
        F.col("o_orderpriority").alias("Company Name"), F.lit("Clerk").alias("Job Title"),
        F.lit("https://board.example").alias("Job Url"), F.col("answers").alias("Question And Answers"))
    sinks.write_snapshot_csv(exports, f"{folder}/one")
    read = readers.read_applications_csv(spark, [f"{folder}/one", f"{folder}/missing"])
    return read.groupBy("Company Name").agg(
        F.count(F.lit(1)).alias("applications"), F.sum(F.length("Question And Answers")).alias("answered"))


@query("feature_csv", f"""WITH {ctes('questions')} SELECT o_orderkey::VARCHAR AS "Job_Url", o_orderdate - INTERVAL 2 HOUR AS "Application_Date",
  o_orderkey % 4 = 0 AS "Ask_Python" FROM questions""")
def _(spark, sf_dir):
    folder = f"{shared_folder(spark)}/features-{uuid4().hex}"
    asked = Q.with_questions(table(spark, sf_dir, "questions"), "answers")
    wide = Q.feature_matrix(Q.with_features(asked).select(
        F.date_format("o_orderdate", "M/d/yyyy, h:mm a").alias("Application_Date"),
        F.lit("n/a").alias("Company_Name"), F.lit("Clerk").alias("Job_Title"),
        F.col("o_orderkey").cast("string").alias("Job_Url"), "features"), ["Ask_Python"])
    sinks.write_snapshot_csv(Q.fill_flags(wide), folder)
    return readers.read_feature_csv(spark, folder).select("Job_Url", "Application_Date", "Ask_Python")


@query("clean_mail_files", f"""WITH {ctes('match_mail')} SELECT filename, 'me@home.net' AS "to", 'About ' || role AS subject, 'Body' AS body,
  (epoch_us("date") // 1000)::VARCHAR || '_hr_firm_example' AS message_key FROM match_mail
  QUALIFY row_number() OVER (PARTITION BY "date", role ORDER BY filename DESC) = 1""")
def _(spark, sf_dir):
    folder = f"{shared_folder(spark)}/clean-{uuid4().hex}"
    clean = analysed_mail(spark, sf_dir).withColumns(
        {"date": X.iso_utc(F.col("date")), "cc": F.lit("")}).drop("analysis")
    # two writes that overlap: the second adds to the first
    event = F.split("filename", "_")[1].cast("long")
    sinks.write_clean(clean.where(event % 3 < 2), folder, "parquet")
    sinks.write_clean(clean.where(event % 3 > 0), folder, "parquet")
    return spark.read.parquet(folder).select("filename", "to", "subject", "body", "message_key")
