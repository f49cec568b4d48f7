"""Rules, fingerprints, containment and token counts against plain Python."""

import random
import re

import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from applytrail.llm import decontamination, quality_rules, simhash, token_counts
from applytrail.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

# null, empty, blank, short, repeated, very long and odd texts; a null id, a repeated row
TEXTS = [None, "", " \n\t", "one", "two words", "The the THE the the the the", "a b c a b c a b c " * 30,
         "x" * 5000, "line one\nline one\n\nline two\nline one", "éa ßb c d \x0b e", "no#sym * bols $ % & | < >",
         " ".join(f"word{i}" for i in range(40_000)), " ".join(["of the people"] + [f"w{i}" for i in range(80)])]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "lost id"), (3, "one")]


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with columns whose names the operators use themselves."""
    rows = [(i, t, "x", 7, 0.5, "y", 1) for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, fp int, score double, w string, n_words int")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def by_id(rows, *names):
    return sorted(((r[0], *[r[n] for n in names]) for r in rows), key=str)


def measured(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    seen, cover = {}, set()
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i:i + 3]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            cover |= {i + k for i in places for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover))


def test_rules_count_exactly(docs, spark):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = by_id(quality_rules.judge(docs).collect(), *names, "base_failed")
    want = sorted(((i, *m, m[0] < 50 or 100 * m[4] > 50 * m[0]) for i, t in ROWS for m in [measured(t)]), key=str)
    assert got == want
    assert quality_rules.judge(empty(spark)).count() == 0


def test_rules_with_many_repeats(spark):
    random.seed(4)
    rows = [(k, " ".join(random.choices("abcdefgh"[: 2 + k % 7], k=random.randint(0, 400)))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_id(quality_rules.judge(df).collect(), "n_repeat_words") == sorted(
        ((i, measured(t)[4]) for i, t in rows), key=str)


def test_rules_stay_free_of_python_and_repeat_no_split(docs):
    kept = quality_rules.judge(docs, keep=("doc_id", "text")).where("kept")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert plan.count("xxhash64") == 1


def bits(text):
    w = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] if len(w) > 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def test_fingerprints(docs, spark):
    rows = simhash.near_duplicates(docs)
    got = by_id(rows.select("id", simhash.hex16(rows["fp"]).alias("h")).collect(), "h")
    assert got == sorted(((i, f"{bits(t):016x}") for i, t in ROWS), key=str)
    component = {r["id"]: r["component"] for r in rows.collect()}
    assert component[0] == component[1] == component[2] == 0  # null, empty and wordless are equal
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_close_pairs_lose_no_link(spark):
    """A crowded ball of near fingerprints, far ones and signs: every link, against all pairs."""
    random.seed(1)
    ball = {0x0F0F123456789ABC}
    while len(ball) < 500:
        f = 0x0F0F123456789ABC
        for b in random.sample(range(64), random.randint(1, 3)):
            f ^= 1 << b
        ball.add(f)
    fps = sorted(ball | {random.getrandbits(64) for _ in range(100)} | {0, 1, 1 << 63, (1 << 64) - 1})
    nodes = spark.createDataFrame([(i, simhash._as_long(f)) for i, f in enumerate(fps)], "id long, fp long")
    got = {tuple(sorted(r)) for r in simhash.close_pairs(nodes).collect()}
    want = {(a, b) for a in range(len(fps)) for b in range(a + 1, len(fps)) if (fps[a] ^ fps[b]).bit_count() <= 2}
    assert got == want


def test_components_of_a_long_chain(spark):
    random.seed(3)
    ids = list(range(300))
    random.shuffle(ids)
    edges = [(a, b) for a, b in zip(ids, ids[1:], strict=False) if ids.index(a) != 149] + [(5, 5)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    left, right = ids[:150], ids[150:]
    assert got == {**dict.fromkeys(left, min(left)), **dict.fromkeys(right, min(right))}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_containment_equals_brute_force(spark):
    random.seed(5)
    words = [f"v{i}" for i in range(60)]
    items = [(i, " ".join(random.choices(words, k=random.randint(0, 30)))) for i in range(40)] + [
        (None, "Only four words, here"), (7, None), (8, "Only four words, here")]
    docs = []
    for i in range(120):
        body = random.choices(words + ["zz"], k=random.randint(0, 60))
        own = (random.choice(items)[1] or "").split()
        for _ in range(random.randint(0, 3)):
            if own:
                own[random.randrange(len(own))] = "changed"
        docs.append((i, " ".join(body + own + body[:9]).upper()))
    docs += [(200, None), (201, "say ONLY four\twords here. now"), (None, "only four words here")]

    def shingles(text, k):
        w = [x.decode() for x in decontamination.words_of(text or "")]
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()

    want = []
    for d, t in docs:
        for i, u in items:
            k = min(5, len(decontamination.words_of(u or "")))
            own = shingles(u, k) if k else set()
            shared = len(own & shingles(t, k)) if own else 0
            if own and 10 * shared >= 8 * len(own):
                want.append((d, i, shared, len(own)))
    a = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    for block in (4_000_000, 150):  # one pass and many
        got = decontamination.contained(a, b, block_chars=block).collect()
        assert by_id([(r["id"], r["item_id"], r["shared"], r["shingles"]) for r in got]) == by_id(
            [(r[0],) for r in want]) or sorted(map(str, [tuple(r)[:4] for r in got])) == sorted(map(str, want))
    flagged = {r["doc_id"] for r in a.where(decontamination.contains_any(a, b)).collect()}
    assert flagged == {d for d, *_ in want}
    for block in (4_000_000, 900):
        clean = decontamination.without_contained(a, b, block_chars=block)
        assert clean.columns == a.columns
        assert by_id([(r["doc_id"],) for r in clean.collect()]) == by_id([(d,) for d, _ in docs if d not in flagged])
    assert decontamination.without_contained(a, b.limit(0)).count() == len(docs)
    assert decontamination.contained(a, b.limit(0)).count() == 0
    assert decontamination.contained(a.limit(0), b).count() == 0


def test_item_blocks_follow_size_classes():
    plan = decontamination.block_plan([(4, 900), (2, 30), (3, 60), (5, 40), (6, 70)], 100)
    assert plan == [[(2, 0, 1), (3, 0, 1)], *[[(4, s, 9)] for s in range(9)], [(5, 0, 1)], [(6, 0, 1)]]
    assert decontamination.block_plan([], 100) == []
    assert [decontamination.size_class(n) for n in (1, 2, 3, 4, 7, 8)] == [1, 2, 2, 3, 3, 4]


def test_sketches_of_a_class_have_one_length():
    texts = [" ".join(f"w{i}x{j}" for j in range(n + 4)) for i, n in enumerate((8, 11, 15, 16, 31))]
    items = decontamination.Items.of(enumerate(texts), 5, 0.8)
    assert [c.smallest for c in items.classes[5]] == [7, 13]
    # 8 and 16 shingles: the sketch of the class is longer than what the item itself may miss
    assert items.least == [4 - 1, 4 - 2, 4 - 3, 7 - 3, 7 - 6]
    ready = items.ready()
    for i, t in enumerate(texts):
        assert ready.contained_in(f"before {t} after", 0.8) == [(i, len(t.split()) - 4, len(t.split()) - 4)]
        words = t.split()
        half = " ".join(words[:len(words) // 2])
        assert ready.contained_in(half, 0.8) == []


def test_token_counts_equal_the_library(docs, spark):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    got = by_id(token_counts.token_counts(docs, VOCABULARY).collect(), "n_bytes", "n_tokens", "over_limit")
    want = []
    for i, t in ROWS:
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 2048))
    assert got == sorted(want, key=str)
    assert token_counts.token_counts(empty(spark), VOCABULARY).count() == 0


def test_token_counts_of_odd_characters():
    random.seed(1)
    alphabet = ["a", "B", "é", "é", "İ", "ß", "Σ", " ", "\t", "\x1c", "\x1f", "\x85", " ", "​",
                "　", "᠎", "<|startoftext|>", "<|endoftext|>", "'s", "1", "23", "!", "\U0001f600", "中", "ﬁ"]
    texts = ["".join(random.choices(alphabet, k=random.randint(0, 14))) for _ in range(3000)]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    table = dict(zip(["a", "B"], token_counts._lengths(tokenizer, ["a", "B"]), strict=True))
    counts = token_counts.Counts(tokenizer, table)
    want = [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert counts.batch(texts[:1500]) + counts.batch(texts[1500:]) == want
