"""Line dedup, phrase mining and spelling variants against plain Python."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from applytrail.llm import line_dedup, phrases, spellings
from applytrail.llm.common import table
from applytrail.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK = " \t\n\x0b\f\r"


def frame(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "k", 1, "m", 0.5, 7) for r in rows],
                                 "doc_id long, text string, lang string, key string, n int, mark string, last double, batch int")


# --- line dedup

def deduped(rows):
    holders = collections.defaultdict(list)
    for i, t, *_ in rows:
        for k in {x.strip(BLANK).translate(LOWER) for x in (t or "").split("\n")}:
            if len(k) >= 40:
                holders[k].append(i)
    lost = {k: max((i for i in v if i is not None), default=None) for k, v in holders.items() if len(v) >= 5}
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = []
        for x in lines:
            last = lost.get(x.strip(BLANK).translate(LOWER))
            if last is None or i == last:
                kept.append(x)
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def test_line_dedup_against_brute_force(spark):
    random.seed(3)
    shared = [f"a line number {k} that is shared by several documents é{'x' * k}" for k in range(30)]
    shared += ["short line", "", "é" * 39, "é" * 40, " " + "y" * 40]
    rows = []
    for i in range(200):
        lines = random.choices(shared, k=random.randint(0, 12)) + [f"own line {i} " + "z" * 40]
        lines = [random.choice(["", " ", "\t\x0b"]) + random.choice([x, x.upper() if x.isascii() else x]) + random.choice(["", "\r", "\f "]) for x in lines]
        random.shuffle(lines)
        rows.append((i, "\n".join(lines), "en"))
    rows += [(None, None, None), (300, "", None), (301, "\n\n", None), (None, "\n".join(shared), "en"), (7, rows[7][1], "en"),
             (302, "\n".join(shared * 400), "en")] + [(None, "a line that only rows without an id have, often", "en")] * 6
    for batches in (1, 5):
        got = line_dedup.dedup_lines(frame(spark, rows), batches=batches).collect()
        assert sorted(((r["id"], r["n_lines"], r["n_dropped"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in got), key=str) == deduped(rows)
    assert line_dedup.dedup_lines(frame(spark, rows).limit(0)).count() == 0


def test_line_query_against_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    got = QUERIES["op11_line_dedup"](spark, SMALL).collect()
    assert sorted(map(tuple, got), key=str) == deduped(rows)
    assert any(r["n_dropped"] for r in got)


def test_runs_are_levelled_and_met_without_a_shuffle(spark):
    runs = line_dedup.LineRuns(spark, min_docs=2)
    for part in range(6):
        runs.add(spark.createDataFrame([(d, f"{k}".encode()) for d in range(part, 30, 6) for k in range(d, d + 3)], "id long, key binary"))
    assert [len(level) for level in runs.levels] == [0, 1, 1]
    assert {(bytes(r["key"]), r["last"]) for r in runs.common().collect()} == {(f"{k}".encode(), min(k, 29)) for k in range(1, 31)}
    merged = line_dedup.LineRuns._merged([r for level in runs.levels for r in level])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and "Sort " not in plan
    runs.close()


# --- phrases

def mined(rows, support, top):
    f, total = collections.Counter(), collections.Counter()
    for _, t, lang in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n-\r]", (t or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for m in range(1, 5):
                f.update((lang, tuple(w[i:i + m])) for i in range(len(w) - m + 1))
    f = {k: a for k, a in f.items() if a >= support}
    rows = collections.defaultdict(list)
    for (lang, p), a in f.items():
        if len(p) == 1:
            continue
        score, k = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
        if any(len(q) > len(p) and other == lang and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q)))
               for (other, q), b in f.items()):
            continue
        rows[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, rank + 1, p.decode(), -a, left, right, total[lang], -score) for lang, found in rows.items()
                  for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top]))


def prose(n):
    random.seed(5)
    words = ["the", "of", "a", "in", "é", "ß", "x", "very", "New", "york", " ", "日本"]
    rows = []
    for i in range(n):
        picked = random.choices(words, weights=range(12, 0, -1), k=random.randint(0, 60))
        rows.append((i, "".join(w + random.choice([" ", " ", "\t", "  ", ". ", "\n", ",", "; "]) for w in picked), random.choice(["en", "de", None, "und"])))
    return rows + [(None, None, "en"), (500, "", "fr"), (501, " \t", "fr"), (3, rows[3][1], rows[3][2]), (502, "the very last " * 3000, "en"), (503, "one " + "z" * 5000, "en")]


@pytest.mark.parametrize("bits", [64, 9])
def test_phrases_against_brute_force(spark, bits):
    """With fingerprints of 9 bits nearly all collide and are counted by their words."""
    rows = prose(150)
    got = phrases.collocations(frame(spark, rows), top=40, support=8, bits=bits).collect()
    assert sorted(map(tuple, got)) == mined(rows, 8, 40)


def test_phrases_of_empty_tables(spark):
    assert phrases.collocations(frame(spark, prose(9)).limit(0)).count() == 0
    assert phrases.collocations(frame(spark, [(1, None, None), (2, "", "en")])).count() == 0


def test_fingerprints_do_not_follow_slices(monkeypatch):
    text = " ".join(f"w{k % 17}é. b" for k in range(4000)).encode()
    whole = phrases.Fingerprints().words_of(text)
    monkeypatch.setattr(phrases, "SLICE", 100)
    cut = phrases.Fingerprints().words_of(text)
    assert (whole.start == cut.start).all() and (whole.end == cut.end).all() and (np.diff(whole.piece) == np.diff(cut.piece)).all()
    assert [text[a:b] for a, b in zip(whole.start, whole.end)] == [w for w in re.split(rb"[. ]", text) if w]
    # equal words have equal values in every slice, other words others
    for values in (*whole.value, *cut.value):
        assert len(set(values.tolist())) == len({text[a:b] for a, b in zip(whole.start, whole.end)}) == 18
    assert set(whole.value[0].tolist()) == set(cut.value[0].tolist())


def test_filter_lets_every_member_pass(spark):
    keys = [random.getrandbits(63) for _ in range(500)]
    made = phrases.filter_of(spark.createDataFrame([(k,) for k in keys], "key long"))
    assert made.has(np.array(keys, dtype=np.uint64)).all()
    assert made.has(np.array([random.getrandbits(64) for _ in range(2000)], dtype=np.uint64)).mean() < 0.1


# --- spelling variants

def edits(word, letters):
    """Every text one edit away from a word."""
    cuts = [(word[:k], word[k:]) for k in range(len(word) + 1)]
    return ({a + b[1:] for a, b in cuts if b} | {a + c + b[1:] for a, b in cuts if b for c in letters}
            | {a + c + b for a, b in cuts for c in letters}) - {word}


def spelled(rows, least=6, min_count=5):
    count = collections.Counter()
    for i, t, *_ in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    count = {w: n for w, n in count.items() if len(w) >= least and n >= min_count}
    letters = set("".join(count))
    out, form = [], {}
    for w, n in count.items():
        near = sorted((-count[v], v) for v in edits(w, letters) & count.keys())
        if near and -near[0][0] >= 5 * n:
            form[w] = near[0][1]
        out.append([w, form.get(w), w, n, len(near), -near[0][0] if w in form else None])
    for row in out:
        while row[2] in form:
            row[2] = form[row[2]]
    return sorted(map(tuple, out))


@pytest.mark.parametrize("tile", [1000, 7])
def test_spellings_against_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(spellings, "TILE", tile)
    random.seed(6)
    words = ["Strasse", "straße", "résumé", "colour", "color\u00d7s", "letters", "elephant", "elephants", "z" * 4000]
    for w in list(words):
        for _ in range(12):
            w = random.choice(sorted(edits(w, "aez\u00e9\u00ff"))[:400])
            words.append(w)
    random.shuffle(words)
    rows = [(i, random.choice([" ", "-", "3", "\n", "\u0101"]).join(random.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=150))) for i in range(120)]
    rows += [(None, None), (200, ""), (None, "elephant " * 60), (201, "abcdef abcdeg abcdefg " * 5),
             (202, "lantern " * 200 + "lanterns " * 30 + "lanternss " * 6), (7, rows[7][1])]
    got = spellings.variants(frame(spark, [(*r, "en") for r in rows])).collect()
    want = spelled(rows)
    assert sorted(map(tuple, got)) == want
    assert sum(r[1] is not None for r in want) > 20 and ("lanternss", "lanterns", "lantern", 6, 1, 30) in want


def test_spelling_query_against_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op13_spelling_variants"](spark, SMALL).collect())) == spelled(rows)


def test_spellings_of_empty_tables(spark):
    assert spellings.variants(frame(spark, [(1, None, None), (2, "", "en"), (3, "short ones", "en")])).count() == 0


def test_one_edit():
    random.seed(1)
    for _ in range(3000):
        a, b = ("".join(random.choices("ab", k=random.randint(0, 6))) for _ in range(2))
        assert spellings.one_edit(a, b) == (b in edits(a, "ab"))
