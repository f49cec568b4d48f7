"""Spelling variants: words one edit apart, found by Gram matrices of letter counts.

Two words one edit apart have letter counts whose squared distance is at most 2, and lengths that
differ by at most 1. Words are dealt into blocks by how many of their letters are of each of
five classes, so near words lie in the same or in neighbouring blocks; a product of
two count matrices gives all distances between two blocks, and only close pairs are spelled out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from applytrail.llm.common import whole_text, written

MIN_CHARS = 6      # code points of a word
MIN_COUNT = 5      # occurrences of a word
RATIO = 5          # a form occurs so many times as often
LOSES = 199        # one in so many runs of a document loses a letter
CLASSES = 5        # of letters, by code point modulo
TILE = 1000        # words, about, on either side of a product
HELD = 200_000     # different words a task counts before it passes them on

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]
_COLUMN = np.zeros(256, dtype=np.int64)
_COLUMN[LETTERS] = np.arange(len(LETTERS))

PAIR = T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())]))


def words_of(text: str, key: str, least: int = MIN_CHARS) -> dict[str, int]:
    """The words of a document with their counts, after runs that the key's hash picks have lost a letter."""
    begun = zlib.crc32(f"{key}:".encode())
    found: Counter[str] = Counter()
    for run, n in Counter(RUN.findall(text.encode().translate(_LOWER).decode())).items():
        if len(run) < least:
            continue
        h = zlib.crc32(run.encode(), begun)
        if h % LOSES == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= least:
            found[run] += n
    return found


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words with ``min_count`` occurrences, counted in the tasks before they are shuffled."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def passed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for name, t in zip(*(batch.column(c).to_pylist() for c in ("id", "t")), strict=True):
                for word, n in words_of(t, name, least).items():
                    seen[word] += n
                if len(seen) > HELD:
                    yield passed_on()
                    seen.clear()
        yield passed_on()

    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), whole_text(text).alias("t"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def letter_counts(words: list[str]) -> np.ndarray:
    """A row per word and a column per letter; doubles hold the products exactly."""
    codes = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
    rows = np.repeat(np.arange(len(words)), [len(w) for w in words])
    cells = np.bincount(rows * len(LETTERS) + _COLUMN[codes], minlength=len(words) * len(LETTERS))
    return cells.reshape(len(words), len(LETTERS)).astype(np.float64)


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced letter turns one word into the other."""
    if len(a) > len(b):
        a, b = b, a
    at = 0
    while at < len(a) and a[at] == b[at]:
        at += 1
    if len(a) == len(b):
        return at < len(a) and a[at + 1:] == b[at + 1:]
    return len(b) - len(a) == 1 and a[at:] == b[at + 1:]


def near_pairs(left: list[str], right: list[str], same: bool) -> list[tuple[int, int]]:
    """Places of near words; ``same`` lists are compared once a pair."""
    a, b = letter_counts(left), letter_counts(right)
    distance = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
    close = distance <= 2
    if same:
        close = np.triu(close, 1)
    return [(int(i), int(j)) for i, j in np.argwhere(close) if one_edit(left[i], right[j])]


@F.arrow_udf(PAIR)
def _near(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    for left, right, same in batches:
        found = [near_pairs(a, b, s) for a, b, s in zip(left.to_pylist(), right.to_pylist(), same.to_pylist(), strict=True)]
        yield pa.array([[{"a": i, "b": j} for i, j in pairs] for pairs in found], kind)


def class_counts(word: str = "word") -> F.Column:
    """How many letters of each class a word has; the length is their sum."""
    members = ["".join(chr(c) for c in LETTERS if c % CLASSES == k) for k in range(CLASSES)]
    return F.array(*[F.length(word) - F.length(F.translate(word, m, "")) for m in members])


def _neighbours(block: F.Column) -> F.Column:
    """Of the blocks one replaced or one added letter away, and the block itself, those that pair with it.

    A replaced letter leads there and back, so only the greater block of the two is listed.
    """
    def moved(gain: int, loss: int | None) -> F.Column:
        return F.transform(block, lambda c, k: c + F.when(k == gain, 1).when(k == (-1 if loss is None else loss), -1).otherwise(0))

    replaced = [moved(gain, loss) for gain in range(CLASSES) for loss in range(CLASSES) if gain != loss]
    return F.concat(F.array(block, *[moved(gain, None) for gain in range(CLASSES)]),
                    F.filter(F.array(*replaced), lambda other: (other > block) & (F.array_min(other) >= 0)))


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, near_n): both directions of every pair of words one edit apart.

    Blocks above ``TILE`` words are cut into tiles by hash; each pair of tiles is one row,
    so work and memory of a task are bounded whatever the size of a block.
    """
    blocked = vocabulary.select("word", "n", class_counts().alias("block"))
    sizes = blocked.groupBy("block").agg(F.ceil(F.count("*") / TILE).alias("cuts"))
    dealt = blocked.join(sizes, "block").withColumn("tile", F.pmod(F.xxhash64("word"), "cuts"))
    tiles = written(dealt.groupBy("block", "tile").agg(F.collect_list(F.struct("word", "n")).alias("w")).select(
        "block", "tile", F.col("w.word").alias("words"), F.col("w.n").alias("counts")), "tiles")

    keys = tiles.select("block", "tile")
    other = keys.select(F.col("block").alias("block2"), F.col("tile").alias("tile2"))
    met = keys.withColumn("block2", F.explode(_neighbours(F.col("block")))).join(other, "block2").where(
        (F.col("block") != F.col("block2")) | (F.col("tile") <= F.col("tile2")))
    right = tiles.toDF("block2", "tile2", "words2", "counts2")
    same = (F.col("block") == F.col("block2")) & (F.col("tile") == F.col("tile2"))
    found = met.join(tiles, ["block", "tile"]).join(right, ["block2", "tile2"]).select(
        "words", "counts", "words2", "counts2", F.explode(_near("words", "words2", same)).alias("p"))
    pairs = found.select(F.expr("words[p.a]").alias("word"), F.expr("counts[p.a]").alias("n"),
                         F.expr("words2[p.b]").alias("near"), F.expr("counts2[p.b]").alias("near_n"))
    pairs = written(pairs, "near")
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                                          F.col("word").alias("near"), F.col("n").alias("near_n")))


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root): ``form`` followed to its end by doubling steps; a form is always more frequent, so there is one."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                F.col("next").isNotNull().alias("moved")), "roots")
        if step.where("moved").isEmpty():
            return now
        now = step.select("word", "root")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = MIN_CHARS, min_count: int = MIN_COUNT,
             ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n): one row per word.

    ``form`` is the most frequent word one edit away, of equal ones the first in code-point
    order, if it occurs ``ratio`` times as often; ``root`` is where forms lead in the end. Null
    and empty texts have no words, a null id counts as an empty one, repeated rows count again.
    An empty table gives no rows. Other columns of ``docs`` play no part.
    """
    words = written(vocabulary(docs, key, text, least, min_count), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    rows = words.join(near, "word", "left").withColumn("best_n", -F.col("best.less"))
    often = F.col("best_n") >= F.col("n") * ratio
    rows = written(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                               F.when(often, F.col("best.near")).alias("form"), F.when(often, F.col("best_n")).alias("form_n")), "forms")
    roots = roots_of(rows.where("form IS NOT NULL"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
