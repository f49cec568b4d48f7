"""The store's manifest, replays and folds; clean mails over several writes."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from applytrail.sources import sinks, store
from applytrail.streaming import jobs as J

SCHEMA = "id string, type string, status string, created_at timestamp"


def records(spark, ids, status, day=1):
    return spark.createDataFrame([(f"r{i}", "job_application", status, datetime(2024, 1, day)) for i in ids], SCHEMA)


def state(spark, path, **kw):
    return {r["id"]: (r["status"], r["created_at"].day) for r in store.read_store(spark, path, **kw).collect()}


def test_batches_replace_base_and_each_other(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "FOLD_SHARE", 100)
    path = str(tmp_path / "s")
    store.init_store(spark, path, records(spark, [], ""))
    want = {}
    for n in range(1, 8):
        store.write_upsert(spark, path, records(spark, range(n, n + 3), f"s{n}", n))
        for i in range(n, n + 3):
            want[f"r{i}"] = (f"s{n}", want.get(f"r{i}", ("", n))[1])
    assert state(spark, path) == want
    plan = store.read_store(spark, path)._jdf.queryExecution().executedPlan().toString()
    # the base, and the batches as ids and as rows, however many there are
    assert plan.count("FileScan parquet") == 3
    assert state(spark, path, before=2) == {f"r{i}": ("s1", 1) for i in (1, 2, 3)}
    store.write_upsert(spark, path, records(spark, [1], "s8", 8))   # the eighth is folded
    want["r1"] = ("s8", 1)
    assert store._manifest(spark, path).batches == [] and state(spark, path) == want
    # the base is not shuffled when it meets a batch
    store.write_upsert(spark, path, records(spark, [2], "s9", 9))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = store.read_store(spark, path)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    over_base = plan[plan.index("LeftAnti"):plan.index("Bucketed: true")]
    assert "Exchange" not in over_base


def test_a_run_that_dies_leaves_the_state_before_it_and_a_replay_replaces(spark, tmp_path):
    path = str(tmp_path / "s")
    store.write_upsert(spark, path, records(spark, range(20), "old"), 0)
    before = state(spark, path)
    store._write_batch(spark, path, records(spark, [1], "lost"), 1)   # no manifest follows
    (tmp_path / "s" / "_half").write_text("{")
    assert state(spark, path) == before and store.next_number(spark, path) == 1
    store.write_upsert(spark, path, records(spark, [1, 2], "once"), 1)
    store.write_upsert(spark, path, records(spark, [1], "again"), 1)
    assert state(spark, path) == {**before, "r1": ("again", 1)}
    assert store.compact(spark, path) == 2 and state(spark, path) == {**before, "r1": ("again", 1)}


def test_batches_of_other_columns(spark, tmp_path):
    path = str(tmp_path / "s")
    store.write_upsert(spark, path, records(spark, [1, 2, 3, 4, 5, 6, 7, 8, 9], "a"))
    store.compact(spark, path)
    store.write_upsert(spark, path, records(spark, [2], "b").withColumn("more", F.lit(7)))
    got = {r["id"]: (r["status"], r["more"]) for r in store.read_store(spark, path).collect()}
    assert got["r1"] == ("a", None) and got["r2"] == ("b", 7) and len(got) == 9


MAILS = "filename string, to string, `from` string, subject string, cc string, date string, body string"


def test_clean_mails_add_up_over_writes(spark, tmp_path):
    path = str(tmp_path / "clean")
    rows = [(f"f{i}", "me@x.y", f"s{i % 7}@x.y", "Hi", "", f"2024-05-{1 + i % 9:02d}T10:15:30Z", f"body {i % 30}") for i in range(60)]
    sinks.write_clean(spark.createDataFrame(rows[:40], MAILS), path)
    files = {p.name for p in (tmp_path / "clean").rglob("part-*")}
    sinks.write_clean(spark.createDataFrame(rows[20:41], MAILS), path)
    kept = {p.name for p in (tmp_path / "clean").rglob("part-*")}
    assert kept & files   # partitions without new mails are not rewritten
    sinks.write_clean(spark.createDataFrame(rows[41:], MAILS), path)
    got = sorted((r["from"], r["date"], r["body"], r["filename"]) for r in spark.read.json(path).collect())
    want = {}
    for f, _, sender, _, _, date, body in sorted(rows):
        want[sender, date, body] = max(want.get((sender, date, body), ""), f)
    assert got == sorted((*k, v) for k, v in want.items())


def test_a_mail_that_comes_again_is_taken_once(spark, tmp_path):
    d = str(tmp_path)
    (tmp_path / "in").mkdir()

    def arrive(name, body):
        (tmp_path / "in" / f"{name}.json").write_text(json.dumps(
            {"Subject": "Hi", "Body": body, "To": "me", "From": "hr@a.b", "DateTimeReceived": "2024-05-01T10:00:00Z"}))

    def run():
        J.intake_stream(spark, f"{d}/in", f"{d}/clean", f"{d}/bad", f"{d}/ck").awaitTermination()
        return sorted(r["body"] for r in spark.read.parquet(f"{d}/clean").collect())

    arrive("a", "one"), arrive("b", "two"), arrive("b2", "two")
    (tmp_path / "in" / "bad.json").write_text('{"Subject": ')
    assert run() == ["one", "two"]
    arrive("c", "one"), arrive("d", "three")
    (tmp_path / "in" / "bad2.json").write_text('{"Subject": ')
    assert run() == ["one", "three", "two"] == run()
    assert spark.read.json(f"{d}/bad").count() == 2
