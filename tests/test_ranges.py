import csv
import random

import pytest
from pyspark.sql import functions as F

from applytrail.operators.savedjobs import saved_jobs
from applytrail.sources import readers

ASOF = "2024-01-31 00:00:00"


@pytest.fixture
def small_ranges(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "700")
    spark.conf.set(names[1], "0")
    yield
    for name, value in zip(names, before, strict=True):
        spark.conf.set(name, value)


def _dump(rng: random.Random, n: int) -> str:
    words = ["Clerk", "Acme · Paris (Remote)", "Applied 3d ago", "Add note", "Notes", "é – ü", "\n", "\n", " ", "\r\n", "Notes\nAdd note",
             "Notes Add note", "NotesAdd note", "Add noteAdd note", "notes Add note", "Not moving forward", "Notes Add note"]
    return "".join(rng.choice(words) + rng.choice(["\n", "\n", " ", ""]) for _ in range(n))


def test_dumps_by_ranges_equal_whole_texts(spark, tmp_path, small_ranges):
    rng = random.Random(7)
    ends = ["", "Notes", "Notes Add note", "Clerk Add note", "Notes\nAdd note\n", "Add note", "é", "Add not"]
    for k in range(16):
        (tmp_path / f"d{k}.txt").write_bytes((_dump(rng, rng.choice([0, 3, 200, 500])) + ends[k % len(ends)]).encode())
    asof = F.lit(ASOF).cast("timestamp")
    whole = saved_jobs(spark.read.text(str(tmp_path), wholetext=True), asof)
    ranged = readers.read_saved_jobs(spark, str(tmp_path), asof, limit=0)
    assert sorted(map(str, ranged.collect())) == sorted(map(str, whole.collect()))
    assert whole.count() > 100
    mixed = readers.read_saved_jobs(spark, str(tmp_path), asof, limit=2000)
    assert sorted(map(str, mixed.collect())) == sorted(map(str, whole.collect()))


def test_one_large_dump_is_read_by_several_tasks(spark, tmp_path, small_ranges):
    (tmp_path / "one.txt").write_text("".join(f"Clerk {i}\nAcme {i} · Paris\nNotes\nAdd note\n" for i in range(400)))
    dumps = readers.read_dumps(spark, str(tmp_path / "one.txt"), limit=0)
    assert dumps.count() >= 400
    scan = readers.pieces(spark, str(tmp_path / "one.txt"), readers.BLOCK_END, limit=0)
    assert scan.select(F.spark_partition_id().alias("p")).distinct().count() > 4
    got = readers.read_saved_jobs(spark, str(tmp_path / "one.txt"), F.lit(ASOF).cast("timestamp"), limit=0)
    assert {r.role for r in got.collect()} == {f"Clerk {i}" for i in range(400)}


def test_quoted_csv_by_ranges_equals_the_whole_file_reader(spark, tmp_path, small_ranges):
    rng = random.Random(11)
    cells = ["", "a", 'x "y"', "two\nlines", "\n\n", '"', '""', "a,b", "é\r\nü", "n/a", "z" * 90, ',"\n",']
    for k in range(10):
        with open(tmp_path / f"f{k}.csv", "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f, lineterminator="\r\n" if k % 2 else "\n", quoting=csv.QUOTE_ALL if k % 3 else csv.QUOTE_MINIMAL)
            out.writerow(["", "Job Title", "Answers\nand `more`"])
            for i in range(rng.choice([0, 1, 60, 150])):
                out.writerow([f"{k}-{i}", rng.choice(cells), rng.choice(cells)])
        if k == 3:  # no line break at the end
            path = tmp_path / "f3.csv"
            path.write_bytes(path.read_bytes().rstrip(b"\r\n"))
    whole = spark.read.options(header=True, **readers.CSV_OPTIONS).csv(str(tmp_path))
    ranged = readers.read_quoted_csv(spark, str(tmp_path), limit=0)
    assert ranged.columns == whole.columns
    assert sorted(map(str, ranged.collect())) == sorted(map(str, whole.collect()))
    assert whole.count() > 100


def test_ranges_of_files_without_records(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("A,B\n")
    (tmp_path / "none.txt").write_text("")
    assert readers.read_quoted_csv(spark, str(tmp_path / "empty.csv"), limit=0).collect() == []
    assert readers.read_dumps(spark, str(tmp_path / "none.txt"), limit=0).collect() == []


def test_pieces_are_dealt_by_their_number(spark, tmp_path, monkeypatch):
    from applytrail.sources import scratch
    monkeypatch.setattr(scratch, "TASK_ROWS", 20)
    text = "a,b\n" + "".join(f'{i},"x{i}\ny""{i}"\n' for i in range(100))
    (tmp_path / "one.csv").write_text(text)
    read = readers.read_quoted_csv(spark, str(tmp_path), limit=0)
    assert sorted((int(r.a), r.b) for r in read.collect()) == [(i, f'x{i}\ny"{i}') for i in range(100)]
    # 201 pieces in tasks of 20; without that, no more tasks than shuffles have by default
    assert read.rdd.getNumPartitions() >= 11


def test_payload_files_share_folders(spark, tmp_path):
    from checks import flows
    payloads = spark.range(0, 5 * flows.MAILS_PER_FILE, 1000).selectExpr("id AS event_id", "concat('{\"subject\": \"', id, '\"}') AS json")
    flows.write_payloads(payloads, str(tmp_path / "in"))
    folders = list((tmp_path / "in").glob("folder=*"))
    assert len(folders) == 1 and len(list(folders[0].glob("*.txt"))) == 5
    assert readers.read_emails(spark, [str(tmp_path / "in")]).count() == payloads.count()


def test_texts_are_stored_once_in_rows_of_many_pieces(spark, tmp_path, monkeypatch):
    """No row a line is stored, and what is cut between rows, inside quotes too, is joined again."""
    from applytrail.sources import records
    stored, cut = {}, records.cut
    monkeypatch.setattr(records, "cut", lambda df, name: stored.setdefault(name, cut(df, name)))
    rows = [(str(i), "x\n" * (i % 7) + f'y "{i}"', "" if i % 3 else "z") for i in range(600)]
    with open(tmp_path / "one.csv", "w", newline="") as f:
        out = csv.writer(f, lineterminator="\n", quoting=csv.QUOTE_ALL)
        out.writerows([("a", "b", "c"), *rows])
    want = sorted((a, b, c or None) for a, b, c in rows)
    for chunk in (50, 400, records.CHUNK):
        monkeypatch.setattr(records, "CHUNK", chunk)
        stored.clear()
        got = sorted((r.a, r.b, r.c or None) for r in readers.read_quoted_csv(spark, str(tmp_path), limit=0).collect())
        assert got == want
    assert sum(df.count() for df in stored.values()) < 40
