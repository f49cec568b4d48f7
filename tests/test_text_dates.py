from datetime import datetime

import pytest
from pyspark.sql import functions as F

from applytrail.functions import dates as D
from applytrail.functions import text as X


def test_nullify_and_scalars(column):
    words = [" None ", "NULL", "n/a", "", "None Ltd", None]
    assert column(X.nullify, words) == [None, None, None, None, "None Ltd", None]
    assert column(X.clean_bool, ["True", " false ", "1", "yes", None]) == [True, False, None, None, None]
    assert column(X.clean_int, [" 42 ", "-3", "4.5", "true", "none", "99999999999", None]) == [42, -3] + [None] * 5


def test_company_suffixes_go_in_list_order_once_each(column):
    names = ["Acme (Pty) Ltd", "Foo Holdings Group", "Foo Group Holdings", "Standard Bank South Africa",
             "Bar Inc. Ltd", "  Ltd", "sa", None]
    # " inc." comes after " ltd", so both go; " group" comes before " holdings", so it stays inside
    assert column(X.norm_company, names) == ["acme", "foo", "foo group", "standard bank", "bar", "ltd", "sa", ""]
    assert column(X.norm_title, [" Sales-Rep/Clerk_2 ", None]) == ["sales rep clerk 2", ""]


def test_clean_keys_see_unicode_words(column):
    assert column(X.company_clean, ["Éa-Co, Inc.", "éco", None, "Co"]) == ["éa", "éco", "unknown", ""]
    assert column(X.role_clean, ["Data Analyst (Remote) [6 months]", None]) == ["data analyst", "unknown"]
    for fn in (X.company_clean, X.role_clean, X.squeeze_ws):
        once = column(fn, ["A  (b) - inc Co​ x", "[q] é"])
        assert column(fn, once) == once


def test_company_or_sender(spark):
    df = spark.createDataFrame([("Acme Group", "a@b.c"), (None, "Jobs <hr@firm.co.za>"), (None, "Plain Sender Inc"),
                                (None, None)], "company string, sender string")
    got = [r[0] for r in df.select(X.company_or_sender(F.col("company"), F.col("sender"))).collect()]
    assert got == ["acme", "firm", "plain sender", None]


def test_message_text(column):
    # resolving escapes reads the other characters byte by byte
    assert column(X.ascii_fold, ["café", "caf\\u00e9 \\u0041", "é \\u0041", "ﬁx", None, "plain"]) == [
        "cafe", "cafe A", "A A", "fix", "", "plain"]
    assert column(X.remove_urls, ["a https://x.y/z?q=1 b www.k.l> c", None]) == ["a  b > c", ""]
    assert column(X.squeeze_ws, ["​ a  \t b ", None]) == ["a b", ""]
    assert column(lambda c: X.strip_dash_runs(c, " "), ["a---b——-c--d"]) == ["a b c--d"]


@pytest.mark.parametrize("html, text", [
    ("<title>T &amp; U</title><p>Hi <b>you</b></p>", "T & U\nHi\nyou"),
    ("<style>p{}</style><script>x='<p>'</script>keep", "keep"),
    ("a<!-- note -->b<!DOCTYPE html>c", "a\nb\nc"),
    ("<div><a href=x>gone <i>too</i></a>stays</div>", "stays"),
    ("<div><a>swallows the rest</div>after", "after"),
    ("one<br>two<img src=x>three</p>four", "one\ntwo\nthree\nfour"),
    ("<p>  </p>\n\n\n<p>x</p>", "x"),
    ("a<template>t<p>u</p></template>b", "a\nb"),
    ("<ruby>A<rp>(</rp><rt>x</rt><rp>)</rp></ruby>", "A"),
    ("", ""),
])
def test_html_to_text(column, html, text):
    assert column(X.html_to_text, [html]) == [text]


def test_message_key_never_uses_the_clock(spark):
    df = spark.createDataFrame([("2024-05-06T10:15:30Z", "a.b@c.d", "f1"), ("", "a.b@c.d", "f1"), ("", "a.b@c.d", "f2"),
                                ("2024-05-06T10:15:30Z", None, "f3")], "d string, s string, f string")
    keys = [r[0] for r in df.select(X.message_key(D.parse_mixed_utc(F.col("d")), F.col("s"), F.col("f"))).collect()]
    assert keys[0] == "1714990530000_a_b_c_d" and keys[3] == "1714990530000_unknown"
    assert keys[1].startswith("unknown-") and keys[1] != keys[2]
    empty = spark.createDataFrame([("2024-05-06T10:15:30Z", " ", "f")], "d string, s string, f string")
    assert empty.select(X.message_key(D.parse_mixed_utc(F.col("d")), F.col("s"))).first()[0] == "1714990530000_unknown"


def test_content_digest_keeps_nulls_and_borders_apart(spark):
    rows = [("ab", "c"), ("a", "bc"), (None, "c"), ("", "c"), ("-", "c")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.select(X.content_digest(F.col("a"), F.col("b"))).distinct().count() == len(rows)


def test_role_family_first_match_wins(column):
    roles = ["Data Analyst", "BI engineer", "or lead", "ml data engineer", "Cook", None]
    assert column(X.role_family, roles) == [
        "Data / Analytics", "Data / Analytics", "Operations Research", "Data Science / ML", None, None]


def test_parse_mixed(column):
    texts = ["2024-05-06T10:15:30+02:00", "Mon, 06 May 2024 10:15:30 +0200 (SAST)", "5/6/24, 3:04 PM", "2024-05-06",
             "12:30", "soon", "", None]
    utc = column(D.parse_mixed_utc, texts)
    assert utc[:4] == [datetime(2024, 5, 6, 8, 15, 30)] * 2 + [datetime(2024, 5, 6, 15, 4), datetime(2024, 5, 6)]
    assert utc[4:] == [None] * 4
    written = {
        "May 6, 2024 10:15 AM": (2024, 5, 6, 10, 15), "May 6 2024": (2024, 5, 6), "6 May 2024 10:15 AM": (2024, 5, 6, 10, 15),
        "06-May-2024 10:15": (2024, 5, 6, 10, 15), "2024/05/06 10:15": (2024, 5, 6, 10, 15), "20240506T101530Z": (2024, 5, 6, 10, 15, 30),
        "2024-05-06 3:04:05 PM": (2024, 5, 6, 15, 4, 5), "13/06/2024 10:00": (2024, 6, 13, 10), "6 May 24 10:15:30": (2024, 5, 6, 10, 15, 30),
        "September 6, 2024": (2024, 9, 6), "6 September 2024 10:15": (2024, 9, 6, 10, 15), "Sept 6, 2024": (2024, 9, 6), "Sept. 6, 2024": (2024, 9, 6), "4 June 2024": (2024, 6, 4),
        "2024-05-06T10:15Z": (2024, 5, 6, 10, 15), "2024-05-06T10:15+02:00": (2024, 5, 6, 8, 15), "2024-05-06T10:15:30.25Z": (2024, 5, 6, 10, 15, 30, 250000),
        "May 6, 2024, 10:15 AM": (2024, 5, 6, 10, 15), "6.5.2024 10:15": (2024, 5, 6, 10, 15), "2024.05.06": (2024, 5, 6), "Monday 6 May 2024": (2024, 5, 6),
        "Mon, 06 May 2024 10:15:30.123456 +0200": (2024, 5, 6, 8, 15, 30, 123456), "Mon, 06 May 2024 10:15:30 BST": (2024, 5, 6, 9, 15, 30),
        "5/6/2024 3:04:05 p.m.": (2024, 5, 6, 15, 4, 5), "2024-05": (2024, 5, 1),
        "Mon, 06 May 2024 10:15:30 EST": (2024, 5, 6, 15, 15, 30), "Mon, 06 May 2024 10:15:30 PDT": (2024, 5, 6, 17, 15, 30)}
    assert column(D.parse_mixed_utc, list(written)) == [datetime(*v) for v in written.values()]
    assert column(D.parse_mixed_utc, ["99 May 2024", "6 Foo 2024", "10:15 May", "May", "20241399", "1/2", "13/13/2024"]) == [None] * 7
    board = column(lambda c: D.parse_mixed(c, D.BOARD_ZONE), texts[:3])
    assert board == [datetime(2024, 5, 6, 8, 15, 30)] * 2 + [datetime(2024, 5, 6, 13, 4)]
    assert column(D.parse_us_date, ["03/04/2024", "2024-03-04"]) == [datetime(2024, 3, 4), None]


def test_day_differences_are_not_symmetric(spark):
    df = spark.sql("SELECT timestamp '2024-01-02 00:00:00' a, timestamp '2024-01-02 01:00:00' b")
    got = df.select(D.days_between_floor(F.col("a"), F.col("b")), D.days_between_floor(F.col("b"), F.col("a")),
                    D.whole_days(F.col("a"), F.col("b"))).first()
    assert tuple(got) == (1, 0, 0)


def test_relative_dates(column):
    asof = F.lit("2024-03-31 12:00:00").cast("timestamp")
    phrases = ["Applied 3d ago", "2w", "just now", "Posted 1mo ago", "1yr", "5m", "x", None]
    assert column(lambda c: D.relative_to_date(c, asof), phrases) == [
        datetime(2024, 3, 27, 12, 0, 1), datetime(2024, 3, 10, 12, 0, 1), datetime(2024, 3, 31, 11, 59, 1),
        datetime(2024, 1, 31, 12, 0, 1), datetime(2022, 3, 31, 12, 0, 1), datetime(2024, 3, 31, 11, 54, 1), None, None]
    assert column(lambda c: D.relative_to_date(c, asof), ["Applied 2147483647d ago", "999999999w", "99999999999999999999m"]) == [None] * 3
    assert column(lambda c: D.relative_to_date(c, asof, True), ["1mo ago"]) == [datetime(2024, 3, 31, 11, 58, 1)]


def test_mail_dates_are_read_together(spark):
    from applytrail.operators.mail import conform_dates

    rows = [(datetime(2024, 5, 6, 10, 15), "Mon, 6 May 2024 10:15:00 +0200", "soon", 1), (None, None, "2024-05-06T10:15Z", 2)]
    df = spark.createDataFrame(rows, "date timestamp, interview_date string, action_deadline string, n int")
    got = conform_dates(df)
    assert got.columns == df.columns
    assert {t for c, t in got.dtypes if c != "n"} == {"timestamp"}
    texts = got.select(*[F.date_format(c, "dd HH:mm") for c in got.columns[:3]]).orderBy(F.col("n")).collect()
    assert [tuple(r) for r in texts] == [("06 10:15", "06 08:15", None), (None, None, "06 10:15")]
    assert conform_dates(df.select("n")).columns == ["n"]
