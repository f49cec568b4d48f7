"""Mails of one file name, and mails without a name, stay what they are."""

from datetime import datetime

from pyspark.sql import functions as F

from applytrail.operators import resolve as V
from applytrail.operators.mail import ANALYSIS_FIELDS, BOOLEAN_FIELDS, INTEGER_FIELDS


def batch(spark, rows):
    types = {**dict.fromkeys(BOOLEAN_FIELDS, "boolean"), **dict.fromkeys(INTEGER_FIELDS, "int")}
    known = {"company_applied_for": F.col("company"), "role": F.col("title")}
    fields = [known.get(f, F.lit(None).cast(types.get(f, "string"))).alias(f) for f in ANALYSIS_FIELDS]
    df = spark.createDataFrame(rows, "filename string, company string, title string, date timestamp, body string")
    return df.select("filename", F.lit("me").alias("to"), F.lit("hr").alias("from"), F.lit("Hi").alias("subject"), "date", "body",
                     F.struct(*fields).alias("analysis"))


def test_repeated_file_names_and_blank_names(spark):
    day = lambda month, d=1: datetime(2024, month, d, 9)
    mail = batch(spark, [
        ("f1", "Globex", "Data Analyst", day(5), "from globex"), ("f1", "Hooli", "Welder", day(5), "from hooli"),
        ("f2", "Globex", "Data Analyst", day(5), "more globex"), ("f2", "Initech", "Gardener", day(5), "from initech"),
        ("f2", "Initech", "Gardener", day(5), "from initech"),
        ("g1", None, None, day(1), "first blank"), ("g2", None, None, day(3), "second blank"), ("g3", "", "", day(3), "same day"),
        ("h1", "Acme", None, day(1), "acme early"), ("h2", "Acme", None, day(6), "acme late")])
    board = spark.createDataFrame([("Zed", "Chef", "u", day(4))],
                                  "company_name string, job_title string, job_url string, application_date timestamp")
    asof = F.lit("2024-07-01").cast("timestamp")
    store = V.to_application(V.board_jobs(board), "linkedin", asof)
    rows = [r for r in V.resolve(mail, board, store, asof).collect() if r["record_type"] == "email"]
    got = {r["email_body_preview"]: r for r in rows}
    assert len(rows) == 9 and {k: r["company_name"] for k, r in got.items() if "from" in k or "more" in k} == {
        "from globex": "Globex", "from hooli": "Hooli", "more globex": "Globex", "from initech": "Initech"}
    assert got["from globex"]["job_id"] == got["more globex"]["job_id"]
    assert got["first blank"]["job_id"] != got["second blank"]["job_id"] == got["same day"]["job_id"]
    assert got["acme early"]["job_id"] != got["acme late"]["job_id"]


def test_records_of_a_repeated_job_inherit_once(spark):
    docs = spark.createDataFrame([(n, "hot", None) for n in range(50)] + [(50, "one", "own"), (51, "none", None), (52, None, None)],
                                 "n long, job_id string, linkedin_job_url string")
    masters = spark.createDataFrame([("hot", f"r{n:02}", f"u{n}") for n in range(49, -1, -1)] + [("one", "r", "u"), (None, "a", "lost")],
                                    "job_id string, job_ref string, linkedin_job_url string")
    want = [(n, "u0") for n in range(50)] + [(50, "own"), (51, None), (52, None)]
    for m in (masters, masters.drop("job_ref")):
        got = V.inherit_board_fields(docs, m).orderBy("n").collect()
        assert [(r["n"], r["linkedin_job_url"]) for r in got] == want


def stored(spark, docs):
    """A store as the next batch reads it."""
    return spark.createDataFrame(docs.collect(), docs.schema)


def empty_store(spark, asof):
    board = spark.createDataFrame([("Zed", "Chef", "u", datetime(2024, 1, 4))],
                                  "company_name string, job_title string, job_url string, application_date timestamp")
    return board, V.to_application(V.board_jobs(board), "linkedin", asof)


def test_mails_of_one_file_name_and_job_all_stay(spark):
    at = lambda d, h=9: datetime(2024, 5, d, h)
    rows = [("f1", "Globex", "Analyst", at(1), "one"), ("f1", "Globex", "Analyst", at(2), "two"), ("f1", "Globex", "Analyst", at(2), "three"),
            ("f1", "Globex", "Analyst", at(2), "three"), ("f2", "Globex", "Analyst", at(3), "four")]
    asof = F.lit("2024-07-01").cast("timestamp")
    board, store = empty_store(spark, asof)
    first = V.resolve(batch(spark, rows), board, store, asof)
    mails = [r for r in first.collect() if r["record_type"] == "email"]
    assert sorted(r["email_body_preview"] for r in mails) == ["four", "one", "three", "two"] and len({r["id"] for r in mails}) == 4
    # the file name's own id is used once
    plain = V.X.email_id(F.lit(mails[0]["job_id"]), F.lit("f1"))
    assert sum(r["id"] == spark.range(1).select(plain).first()[0] for r in mails) == 1

    # one after the other, and again: every mail keeps its id and none replaces another
    ids = {}
    for turn in (0, 1):
        for row in rows[:3]:
            out = V.resolve(batch(spark, [row]), board, store, asof)
            store = stored(spark, V.upsert(store, out))
            got = {r["email_body_preview"]: r["id"] for r in out.collect() if r["record_type"] == "email"}
            assert turn == 0 or ids[row[4]] == got[row[4]]
            ids |= got
    assert len(set(ids.values())) == 3
    assert sorted(r["email_body_preview"] for r in store.where("record_type = 'email'").collect()) == ["one", "three", "two"]


def test_jobs_of_unmatched_mails_do_not_follow_the_batches(spark):
    at = lambda d: datetime(2024, 5, d, 9)
    # globex energy - globex enerxy - glbex enexy: the ends do not match each other's names as well
    rows = [("a", "Globex Energy", "Data Analyst", at(1), "a"), ("b", "Globex Enerxy", "Data Analyst", at(3), "b"), ("c", "Glbex Xnex", "Data Analyst", at(9), "c"),
            ("d", "Initech", "Welder", at(2), "d"), ("e", "Initeck", "Welder", at(20), "e"), ("f", "Globex Energy", "Data Analyst", at(25), "f")]
    asof = F.lit("2024-07-01").cast("timestamp")
    board, store = empty_store(spark, asof)
    whole = {r["email_body_preview"]: r["job_id"] for r in V.resolve(batch(spark, rows), board, store, asof).collect()}
    assert whole["a"] == whole["b"] == whole["f"] and whole["d"] == whole["e"] != whole["a"]
    dated = sorted(rows, key=lambda r: r[3])
    parts = {}
    for k in (0, 2, 4):
        out = V.resolve(batch(spark, dated[k:k + 2]), board, store, asof)
        store = stored(spark, V.upsert(store, out))
        parts |= {r["email_body_preview"]: r["job_id"] for r in out.collect()}
    assert parts == whole
