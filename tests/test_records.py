from pyspark.sql import functions as F

from applytrail.operators import enrich as E
from applytrail.operators import mail as M
from applytrail.operators import savedjobs as S
from applytrail.operators import screening as Q
from applytrail.plans import tracker


def test_parse_analysis_traps(spark):
    rows = [("a", '{"role": "None", "is_automated": "true", "test_duration_mins": "45", "type": "Offer"}'),
            ("b", '{"is_automated": true, "test_duration_mins": true, "work_mode": "Moon"}'),
            ("c", '{"role": "cut'), ("d", "[1]"), ("e", None),
            ("f", '{"error": "content_filter", "category": "Not Job Related"}')]
    parsed = {r["filename"]: r for r in M.parse_analysis(
        spark.createDataFrame(rows, "filename string, analysis_json string")).collect()}
    a, b = parsed["a"]["analysis"], parsed["b"]["analysis"]
    assert (a["role"], a["is_automated"], a["test_duration_mins"], a["type"]) == (None, True, 45, "Offer")
    assert (b["is_automated"], b["test_duration_mins"]) == (True, None)
    assert [parsed[k]["error"] for k in "abcdef"] == [None, None, "unparseable", "unparseable", "unparseable", "content_filter"]
    enums = M.validate_enums(M.parse_analysis(spark.createDataFrame(rows, "filename string, analysis_json string")))
    assert [tuple(r) for r in enums.collect()] == [("work_mode", "Moon", 1)]


def test_null_type_survives_filters(spark):
    columns = "notification_type string, company string, role string, is_automated boolean, portal string, action_type string"
    rows = [(None, None, None, None, None, None), ("Unrelated", "A", "r", False, "p", "x"), ("Job ad", "A", "r", False, "p", "x"),
            ("Unknown", "Unknown", "None", None, None, ""), ("Unknown", "Unknown", "None", True, None, ""), ("Offer", "A", "r", None, "p", "x")]
    df = spark.createDataFrame(rows, columns)
    assert M.drop_unrelated(df).count() == 4
    assert M.drop_empty(M.drop_unrelated(df)).count() == 3


def test_extractor_and_quarantine(spark):
    df = spark.createDataFrame([("a", "hello", None), ("b", "x", "boom")], "filename string, subject string, body string")

    def extractor(texts):
        assert all(t.startswith("Email Subject: ") for t in texts)
        return texts.map(lambda t: "oops" if "boom" in t else '{"role": "Clerk"}')

    good, bad = E.split_quarantine(E.analyse(df, extractor))
    assert [r["analysis"]["role"] for r in good.collect()] == ["Clerk"]
    assert [(r["filename"], r["analysis"]["category"]) for r in bad.collect()] == [("b", "Not Job Related")]


DUMP = """Data Analyst
Acme Bank · Cape Town (Hybrid)\r
Applied 3d ago
Posted 2w ago
Application viewed
Notes
Add note
Engineer
Cape Town · Remote
Reposted 1mo ago
(No longer accepting applications)
Notes Add note
Solo role
Notes
Add note
Foo • Bar (On-site)
Resume downloaded
Interview
Notes
Add note
Applied just now
Notes
Add note
X
Johannesburg Metropolitan Area
Not moving forward
Saved 3
"""


def test_saved_jobs(spark):
    df = spark.createDataFrame([(DUMP,), ("",)], "value string")
    got = S.saved_jobs(df, F.lit("2024-03-31 12:00:00").cast("timestamp")).collect()
    seen = [(r.role, r.company, r.location, r.work_type, r.listing_status, r.app_viewed, r.outcome) for r in got]
    assert seen == [
        ("Data Analyst", "Acme Bank", "Cape Town", "Hybrid", "open", True, None),
        ("Engineer", None, "Cape Town Remote", None, "closed", False, None),
        ("Solo role", None, None, None, "open", False, None),
        (None, "Foo", "Bar", "On-site", "open", True, "Interview"),
        ("X", None, "Johannesburg Metropolitan Area", None, "open", False, "Not moving forward"),
    ]
    assert got[1].raw_reposted == "Reposted 1mo ago" and got[1].raw_posted is None
    assert tuple(got[0].asDict()) == S.COLUMNS


QA = ("How many years of SQL: 3 | Do you have 2+ years of Python and sql?: Yes | five years excel: a | x: b|c | "
      "First name: k | are you legally authorized to work: y | visa sponsorship?: n | hybrid or remote: z | "
      "bachelor or master: q | ind code: urn:li:industry:999 | sector: urn:li:industry:43 | How many years of SQL: 7")


def test_questions(spark):
    df = spark.createDataFrame([("a", QA), ("b", None), ("c", "Tableau: 4")], "id string, `Question And Answers` string")
    asked = Q.with_questions(df).select("id", "questions")
    long = Q.explode_questions(asked).filter("id = 'a'").collect()
    assert [(r.question, r.answer) for r in long][0] == ("How many years of SQL", "7")
    assert ("x", "b|c") in [(r.question, r.answer) for r in long] and len(long) == 11
    features = {r.id: r.features for r in Q.with_features(asked).collect()}
    assert features["a"] == {
        "Ask_SQL": None, "Ask_Python": None, "Req_Years_Python": 2, "Req_Years_SQL": 2, "Ask_Excel": None,
        "Req_Years_Excel": 5, "Ask_Visa_Auth": None, "Req_Hybrid": None, "Req_Bachelors": None,
        "Ask_Ind_URN_999": None, "Ask_Ind_FinancialServices": None}
    assert features["b"] == {} and features["c"] == {"Ask_Tableau": None}
    narrow = Q.with_features(asked, whole_field=False).filter("id = 'a'").first().features
    assert not any("Ind_" in f for f in narrow)


def test_every_synonym_finds_its_topic(spark):
    words = [(w, t) for t, ws in Q.TOPICS.items() for w in ws]
    df = spark.createDataFrame([(w, t) for w, t in words], "w string, t string")
    asked = df.select("t", "w", F.array(F.struct(
        F.lit(1).alias("position"), F.concat(F.lit("is "), F.rtrim("w"), F.lit(" ok")).alias("question"),
        F.lit("").alias("answer"))).alias("questions"))
    tagged = Q.tag_topics(asked).collect()
    assert len(tagged) == len(words)
    assert [r.w for r in tagged if r.t not in r.topics] == []


def test_feature_table_drops_sparse_and_fills(spark):
    rows = [("1/2/24", "A", "r", "u1", "Python years: 1 | sql: 2"), ("1/3/24", "B", "r", "u2", "Python: 3"), ("1/4/24", "C", "r", "u3", None)]
    exports = spark.createDataFrame(rows, ["Application Date", "Company Name", "Job Title", "Job Url", "Question And Answers"])
    wide = tracker.feature_table(exports)
    assert wide.columns == ["Application_Date", "Company_Name", "Job_Title", "Job_Url", "Ask_Python"]
    assert sorted((r.Job_Url, r.Ask_Python) for r in wide.collect()) == [("u1", True), ("u2", True), ("u3", False)]


def test_feature_table_keeps_unlisted_industries(spark):
    exports = spark.createDataFrame(
        [(f"1/{i}/25, 3:04 PM", "A", "x", f"u{i}", "Which industry? urn:li:industry:977: Yes | Do you know Python?: Yes") for i in (1, 2, 3)],
        "`Application Date` string, `Company Name` string, `Job Title` string, `Job Url` string, `Question And Answers` string")
    columns = tracker.feature_table(exports).columns
    assert "Ask_Python" in columns and any("URN_977" in c for c in columns), columns


def test_sparse_columns_are_counted_on_rows_worked_out_once(spark):
    worked = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def flag(i):
        worked.add(1)
        return True if i % 2 else None

    wide = Q.drop_sparse(spark.range(10).select("id", flag("id").alias("Ask_A"), F.lit(None).cast("boolean").alias("Ask_B")), ["Ask_A", "Ask_B"])
    assert wide.columns == ["id", "Ask_A"] and wide.count() == 10 and sum(r.Ask_A or 0 for r in wide.collect()) == 5
    assert worked.value == 10


def test_stored_rows_are_dealt_by_their_number(spark, tmp_path, monkeypatch):
    from applytrail.sources import scratch
    spark.range(0, 1000, 1, 1).write.parquet(str(tmp_path / "one"))
    monkeypatch.setattr(scratch, "TASK_ROWS", 50)
    dealt = scratch.deal(spark.read.parquet(str(tmp_path / "one")))
    assert dealt.rdd.getNumPartitions() == 20 and dealt.count() == 1000


def test_question_edges(spark):
    texts = [("a", " Python  :  yes\t | Need 10+ years of machine  learning?: x | Need 10+ years of machine learning : 2"),
             ("b", "Q: 1 | r | s: 2|: 3 |été etl: 4 | Q : 5"), ("c", "ai-first full-stack fullstack: visa | offices, BSc? 3 years: urn:li:industry:43")]
    asked = Q.with_questions(spark.createDataFrame(texts, "id string, `Question And Answers` string"))
    got = {r.id: [(q.position, q.question, q.answer) for q in r.questions] for r in asked.collect()}
    assert got["a"] == [(1, "Python", "yes"), (2, "Need 10+ years of machine  learning?", "x"), (3, "Need 10+ years of machine learning", "2")]
    assert got["b"] == [(1, "Q", "5"), (2, "s", "2|: 3"), (3, "été etl", "4")]
    features = {r.id: r.features for r in Q.with_features(asked.select("id", "questions")).collect()}
    assert features["a"] == {"Ask_Python": None, "Ask_DataScience": None, "Req_Years_DataScience": 10}
    assert features["b"] == {"Ask_DataEngineering": None}
    assert features["c"] == {"Ask_DevOps": None, "Req_Onsite": None, "Req_Bachelors": None, "Ask_Ind_FinancialServices": None, "Req_Years_Ind_FinancialServices": 3}
