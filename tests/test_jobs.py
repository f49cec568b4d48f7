import json
from datetime import datetime
from email.message import EmailMessage

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from applytrail.operators import funnel as N
from applytrail.operators import mail as M
from applytrail.operators import resolve as V
from applytrail.sources import readers, sinks
from applytrail.streaming import jobs as J
from checks.catalog import ORACLES, QUERIES
from checks.verify import TABLES, canonical

SMALL = "/root/testdata/sf0.001"


def test_mime(spark, tmp_path):
    both = EmailMessage()
    both["From"], both["To"], both["Subject"] = "hr@acme.com", "me@x.y", "Hi ---- there"
    both.set_content("plain https://x.y/z wins\n")
    both.add_alternative("<p>html</p>", subtype="html")
    html = EmailMessage()
    html["Date"] = "Mon, 06 May 2024 10:15:30 +0200"
    html.set_content("<p>caf&eacute;</p><a href=x>link</a>", subtype="html")
    (tmp_path / "both.eml").write_bytes(bytes(both))
    (tmp_path / "html.eml").write_bytes(bytes(html))
    got = {r.filename: r for r in M.clean_message(readers.read_mime(spark, str(tmp_path))).collect()}
    assert (got["both.eml"].subject, got["both.eml"].body, got["both.eml"].date) == ("Hi there", "plain  wins", "")
    assert (got["html.eml"].body, got["html.eml"]["from"]) == ("cafe", "")


def test_a_damaged_mime_file_is_marked_and_the_others_stay(spark, tmp_path):
    (tmp_path / "bad.eml").write_bytes(b'From: a@b.c\nContent-Type: text/plain; charset="x-unknown-9"\n\nhello\n')
    (tmp_path / "good.eml").write_bytes(b"From: a@b.c\nSubject: Hi\n\nhello\n")
    got = {r.filename: r for r in readers.read_mime(spark, str(tmp_path)).collect()}
    assert "LookupError" in got["bad.eml"].error and got["good.eml"].error is None and got["good.eml"].subject == "Hi"


def test_mails_of_one_key_are_only_merged_when_equal(spark, tmp_path):
    rows = [(f, "me@x.y", "s" * 45 + t, "Hi", "", "2024-05-06T10:15:30Z", b) for f, t, b in
            (("a", "1@x.y", "one"), ("b", "1@x.y", "two"), ("c", "2@x.y", "one"), ("d", "1@x.y", "one"))]
    df = spark.createDataFrame(rows, "filename string, to string, `from` string, subject string, cc string, date string, body string")
    sinks.write_clean(df, str(tmp_path / "out"))
    assert sorted(r.filename for r in spark.read.json(str(tmp_path / "out")).collect()) == ["b", "c", "d"]


def test_read_emails_keeps_missing_analysis_null(spark, tmp_path):
    for folder, record in (("processed", {"filename": "a.json", "from": "x", "analysis": {"role": "n/a", "is_automated": True}}),
                           ("unprocessed", {"filename": "b.json", "from": "y"})):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "m.json").write_text(json.dumps(record, indent=2))
    got = {r.filename: r.analysis for r in readers.read_emails(spark, [f"{tmp_path}/processed", f"{tmp_path}/unprocessed"]).collect()}
    assert got["b.json"] is None and got["a.json"]["is_automated"] is True and got["a.json"]["role"] is None


def test_csv_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Application Date,Company Name,Job Title,Job Url,Question And Answers\n"1/2/25, 3:04 PM",A,"x ""y""",u,"SQL: 1\nPython: 2"\n')
    with pytest.warns(UserWarning):
        df = readers.read_applications_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "none.csv")])
    assert [tuple(r)[1:4] for r in df.collect()] == [("A", 'x "y"', "u")]
    with pytest.warns(UserWarning):
        assert readers.read_applications_csv(spark, [str(tmp_path / "none.csv")]) is None
    (tmp_path / "f.csv").write_text(",Application_Date,Company_Name,Ask_SQL,Req_Years_SQL\n0,2024-01-02,,True,3.0\n1,nope,B,False,False\n")
    rows = readers.read_feature_csv(spark, str(tmp_path / "f.csv")).collect()
    assert [tuple(r) for r in rows] == [(datetime(2024, 1, 1, 22, 0), None, True, 3)]


def test_outcome_boundary_at_three_weeks(spark):
    asof = F.lit("2024-01-31").cast("timestamp")
    events = spark.createDataFrame([("a", "r", "Applied", datetime(2024, 1, 10)), ("b", "r", "Applied", datetime(2024, 1, 9)),
                                    ("b2", "r", "Applied", datetime(2024, 1, 9, 12)), ("c", "r", "Explicit Rejection", None)],
                                   "company_clean string, role_clean string, stage string, event_date timestamp")
    got = {r.company_clean: r.outcome for r in N.outcome3(N.job_funnel(events, asof)).collect()}
    assert got == {"a": "Active", "b": "Ghosted", "b2": "Active", "c": "Rejection"}


def test_stage_flow_edges_conserve_the_total(spark):
    flows = QUERIES["stage_flows"](spark, SMALL)
    ends = flows.filter(F.col("target").isin("Rejected", "Ghosted", "Still Active")).agg(F.sum("value")).first()[0]
    assert ends == QUERIES["stage_totals"](spark, SMALL).first().total_apps


def test_upsert_is_idempotent_and_keeps_created_at(spark):
    schema = "id string, status string, created_at timestamp"
    store = spark.createDataFrame([("a", "old", datetime(2024, 1, 1)), ("b", "old", datetime(2024, 1, 1))], schema)
    updates = spark.createDataFrame([("b", "new", datetime(2024, 2, 1)), ("c", "new", datetime(2024, 2, 1))], schema)
    once = V.upsert(store, updates)
    twice = V.upsert(once, updates)
    want = [("a", "old", datetime(2024, 1, 1)), ("b", "new", datetime(2024, 1, 1)), ("c", "new", datetime(2024, 2, 1))]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == want


def test_streams_end_to_end_and_replay(spark, tmp_path):
    d = str(tmp_path)
    (tmp_path / "in").mkdir()
    mails = [("m1", "Thanks", "<p>ok</p>", "2024-05-01T10:00:00Z", "Acme Ltd"), ("m2", "No", "no", "Mon, 20 May 2024 10:00:00 +0000", "Acme Ltd"),
             ("m3", "Hi", "FAIL", "", "x"), ("m4", "New", "n", "2024-05-02T10:00:00Z", "Quux"), ("m5", "New", "n", "2024-05-09T10:00:00Z", "Quux Inc")]
    for name, subject, body, date, company in mails:
        (tmp_path / "in" / f"{name}.json").write_text(json.dumps(
            {"Subject": f"{subject}|{company}", "Body": body, "To": "me", "From": f"{name}@a.b", "DateTimeReceived": date}))
    (tmp_path / "in" / "bad.json").write_text('{"Subject": ')

    def extractor(texts: pd.Series) -> pd.Series:
        def one(t):
            if "FAIL" in t:
                return "not json"
            return json.dumps({"company_applied_for": t.split("\n")[0].split("|")[1], "role": "Data Analyst", "category": "None"})
        return texts.map(one)

    board = spark.createDataFrame(
        [("Acme", "Data Analyst", "u1", datetime(2024, 4, 30, 10), True), ("Zed", "Chef", "u2", datetime(2024, 4, 30, 10), False)],
        "company_name string, job_title string, job_url string, application_date timestamp, Ask_SQL boolean")
    asof = F.lit("2024-06-01").cast("timestamp")
    sinks.init_store(spark, f"{d}/store", V.to_application(V.board_jobs(board), "linkedin", asof))

    def run(suffix):
        J.intake_stream(spark, f"{d}/in", f"{d}/clean", f"{d}/bad", f"{d}/ck-in{suffix}").awaitTermination()
        J.enrich_stream(spark, f"{d}/clean", f"{d}/done", f"{d}/failed", f"{d}/ck-en{suffix}", extractor).awaitTermination()
        J.resolve_stream(spark, f"{d}/done", lambda: board, f"{d}/store", f"{d}/ck-re{suffix}", lambda: "2024-06-01").awaitTermination()
        rows = sinks.read_store(spark, f"{d}/store").collect()
        return sorted((r.record_type, r.company_name, r.email_filename or "", r.job_id, r.linkedin_job_url or "", r.linkedin_ask_sql) for r in rows)

    first = run("")
    assert spark.read.json(f"{d}/bad").count() == 1 and spark.read.json(f"{d}/failed").count() == 1
    assert [r[:3] for r in first] == [("email", "Acme", "m1.json"), ("email", "Acme", "m2.json"), ("email", "Quux", "m4.json"),
                                      ("email", "Quux", "m5.json"), ("linkedin", "Zed", "")]
    assert first[0][3] == first[1][3] and first[0][4:] == ("u1", True) and first[2][3] == first[3][3]
    assert run("") == first  # nothing new
    assert run("-replay") == first  # everything again
    sinks.compact(spark, f"{d}/store")
    assert sinks.read_store(spark, f"{d}/store").count() == len(first)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.filterwarnings("ignore::UserWarning")
def test_query_equals_oracle(spark, duck, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    assert canonical(got) == canonical(duck.execute(ORACLES[name]).fetchdf())
