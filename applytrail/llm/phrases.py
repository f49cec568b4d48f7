"""Phrase collocations: Rabin-Karp fingerprints of all n-grams, counted by shuffle, read back from the texts.

Fingerprints are prefix polynomials modulo 2^64, over the bytes of a word and then over the words
of an n-gram, so numpy gives those of all n-grams of a batch at once. Only fingerprints are
counted; the words of frequent ones are read from one occurrence each.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from applytrail.llm.common import whole_text, written

LONGEST = 4          # words in a phrase
SUPPORT = 30         # occurrences of a candidate
SCALE = 2_000_000    # score of a phrase whose parts occur nowhere else, times two
COVERED = 80         # percent of a phrase's occurrences that lie in one longer phrase
TOP = 2000           # phrases reported per language
UNKNOWN = "und"
BITS = 64            # of a fingerprint; fewer only make more collisions to settle
SLICE = 1 << 18      # bytes hashed at once
GATHERED = 1 << 20   # characters of the texts counted together before anything leaves a task
FILTER_BITS = 27     # a filter of frequent fingerprints has at most 2^27 bits (16 MB)
PLACE_BITS = 24      # of an occurrence pointer: the word's number; the others are of the row's mark

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BREAK = re.compile(rb"[ \t.,;:!?\n-\r]")
_KIND = np.zeros(256, dtype=np.uint8)   # 0: of a word, 1: blank, 2: ends a piece
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\f\r")] = 2

_RANDOM = np.random.default_rng(12)
_LETTER = _RANDOM.integers(0, 1 << 64, (2, 256), dtype=np.uint64)   # value of each byte, in two independent hashes
_BASES = [int(b) | 1 for b in _RANDOM.integers(1 << 60, 1 << 63, 4)]
_STIR = [np.uint64(int(v) | 1) for v in _RANDOM.integers(1 << 60, 1 << 63, 2)]
_PLACE = (1 << PLACE_BITS) - 1


def _stirred(x: np.ndarray) -> np.ndarray:
    for odd in _STIR:
        x = (x ^ (x >> np.uint64(31))) * odd
    return x ^ (x >> np.uint64(32))


class Polynomial:
    """Prefix sums of values times powers of an odd base, modulo 2^64: the hash of any window in one step."""

    def __init__(self, base: int):
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        for name, base in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
            powers = np.full(n, base, dtype=np.uint64)
            powers[0] = 1
            setattr(self, name, np.cumprod(powers, dtype=np.uint64))

    def windows(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(values) > len(self.up):
            self._grow(max(len(values), 2 * len(self.up)))
        sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self.up[: len(values)], out=sums[1:])
        return (sums[ends] - sums[starts]) * self.down[starts]


@dataclass
class Words:
    """The words of a buffer in order: byte range, number of the piece, value in both hashes."""

    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    value: list[np.ndarray]


@dataclass
class Fingerprints:
    """Hashes of the words and n-grams of texts; one per task, it keeps the powers it has computed."""

    bits: int = BITS
    letters: list[Polynomial] = field(default_factory=lambda: [Polynomial(b) for b in _BASES[:2]])
    words: list[Polynomial] = field(default_factory=lambda: [Polynomial(b) for b in _BASES[2:]])

    def words_of(self, data: bytes) -> Words:
        """``data`` is lower-cased; slices end behind a word, so any length takes bounded memory but for the words."""
        parts, pieces, at = [], 0, 0
        while at < len(data):
            stop = at + SLICE
            if stop < len(data):
                found = _BREAK.search(data, stop)
                stop = found.end() if found else len(data)
            octets = np.frombuffer(data, dtype=np.uint8, count=min(stop, len(data)) - at, offset=at)
            kind = _KIND[octets]
            inside = np.zeros(len(octets) + 2, dtype=np.int8)
            inside[1:-1] = kind == 0
            turns = np.diff(inside)
            start, end = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
            piece = np.cumsum(kind == 2, dtype=np.int64)
            value = [_stirred(p.windows(_LETTER[k][octets], start, end)) for k, p in enumerate(self.letters)]
            parts.append((start + at, end + at, piece[start] + pieces, *value))
            pieces, at = pieces + int(piece[-1]), stop
        if not parts:
            none = np.zeros(0, dtype=np.int64)
            return Words(none, none, none, [none.astype(np.uint64)] * 2)
        start, end, piece, *value = (np.concatenate(p) for p in zip(*parts, strict=True))
        return Words(start, end, piece, value)

    def grams(self, values: np.ndarray, size: int, which: int = 0) -> np.ndarray:
        """Of the ``size`` words from each word on."""
        starts = np.arange(max(len(values) - size + 1, 0))
        return _stirred(self.words[which].windows(values, starts, starts + size))

    def keys(self, grams: np.ndarray, languages: np.ndarray) -> np.ndarray:
        return (grams ^ languages) >> np.uint64(64 - self.bits)


def language_hash(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang, 12)


class Filter:
    """A set of fingerprints that may hold a few too many but none too few, in at most 2^``FILTER_BITS`` bits."""

    def __init__(self, bits: int, words: np.ndarray):
        self.bits, self.words = bits, words

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), dtype=bool)
        for slot in (keys >> np.uint64(64 - self.bits), keys & np.uint64((1 << self.bits) - 1)):
            found &= (self.words[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found


def filter_of(keys: DataFrame) -> Filter:
    """The filter of a table's ``key`` column, its words put together by the executors."""
    bits = min(max((16 * keys.count()).bit_length(), 10), FILTER_BITS)
    slots = F.explode(F.array(F.shiftrightunsigned("key", 64 - bits), F.col("key").bitwiseAND((1 << bits) - 1)))
    words = keys.select(slots.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 AS int))")).alias("bit")).toPandas()
    filled = np.zeros(1 << (bits - 6), dtype=np.uint64)
    filled[words["word"].to_numpy()] = words["bit"].to_numpy().view(np.uint64)
    return Filter(bits, filled)


@dataclass
class Batch:
    """Rows of texts as one buffer, and the n-grams of one size that a filter of the next smaller ones lets pass."""

    data: bytes
    languages: list[str]
    words: Words
    row: np.ndarray     # of each n-gram kept
    first: np.ndarray   # number of its first word in the buffer
    number: np.ndarray  # and in the row
    key: np.ndarray
    check: np.ndarray

    def phrase(self, first: int, size: int) -> str:
        w = self.words
        return b" ".join(self.data[w.start[k]:w.end[k]] for k in range(first, first + size)).decode()


def batch_of(prints: Fingerprints, texts: list[str], languages: list[str], size: int, known: Filter | None) -> Batch:
    """Pieces end with the text: a line feed stands between two rows."""
    encoded = [t.encode().translate(_LOWER) for t in texts]
    begins = np.cumsum([0, *(len(e) + 1 for e in encoded)])[:-1]
    data = b"\n".join(encoded)
    words = prints.words_of(data)
    row = np.searchsorted(begins, words.start, "right") - 1
    hashes = {lang: language_hash(lang) for lang in set(languages)}
    of_lang = np.array([hashes[lang] for lang in languages], dtype=np.uint64)[row] if len(row) else np.zeros(0, np.uint64)
    n = max(len(words.start) - size + 1, 0)
    valid = words.piece[:n] == words.piece[size - 1:]
    if known is not None and n:
        smaller = known.has(prints.keys(prints.grams(words.value[0], size - 1), of_lang[: n + 1]))
        valid &= smaller[:-1] & smaller[1:]
    first = np.flatnonzero(valid)
    key = prints.keys(prints.grams(words.value[0], size)[first], of_lang[first])
    check = prints.grams(words.value[1], size, 1)[first] >> np.uint64(32)
    return Batch(data, languages, words, row[first], first, first - np.searchsorted(words.start, begins)[row[first]], key, check)


COUNTS = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("key", pa.int64()), ("n", pa.int64()),
                    ("low", pa.int64()), ("high", pa.int64()), ("place", pa.int64())])


def counts_of(batch: Batch, marks: np.ndarray, size: int) -> pa.RecordBatch:
    """One row per fingerprint: occurrences, least and greatest check value, least pointer to an occurrence.

    With size 1 a row of size 0 per text's language counts its words.
    """
    order = np.argsort(batch.key, kind="stable")
    key, row, check = batch.key[order], batch.row[order], batch.check[order].astype(np.int64)
    codes = {lang: k for k, lang in enumerate(dict.fromkeys(batch.languages))}
    code = np.array([codes[lang] for lang in batch.languages], dtype=np.int32)[row] if len(row) else np.zeros(0, np.int32)
    place = marks[row] & ~_PLACE | batch.number[order] & _PLACE if len(row) else np.zeros(0, np.int64)
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (code[1:] != code[:-1])
    at = np.flatnonzero(new)
    least = [f.reduceat(v, at) if len(at) else v for f, v in ((np.minimum, check), (np.maximum, check), (np.minimum, place))]
    columns = [code[at], np.full(len(at), size, np.int32), key[at].view(np.int64), np.diff([*at, len(key)]).astype(np.int64), *least]
    if size == 1:
        total = np.bincount(code, minlength=len(codes))
        zero = np.zeros(len(codes), dtype=np.int64)
        more = [np.arange(len(codes), dtype=np.int32), zero.astype(np.int32), zero, total, zero, zero, zero]
        columns = [np.concatenate(pair) for pair in zip(columns, more, strict=True)]
    lang = pa.array(list(codes), pa.string()).take(pa.array(columns[0]))
    return pa.RecordBatch.from_arrays([lang, *map(pa.array, columns[1:])], schema=COUNTS)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """The columns of the rows in portions of at least ``GATHERED`` characters of text, or one longer text more."""
    held: dict[str, list] = {}
    size = 0
    for batch in batches:
        columns = batch.to_pydict()
        begun = 0
        for at, text in enumerate(columns["t"], 1):
            size += len(text)
            if size >= GATHERED or at == batch.num_rows:
                for name, values in columns.items():
                    held.setdefault(name, []).extend(values[begun:at])
                begun = at
            if size >= GATHERED:
                yield held
                held, size = {}, 0
    if held:
        yield held


def _rows(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    return docs.select(F.xxhash64(F.col(key), whole_text(text)).alias("mark"),
                       F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), whole_text(text).alias("t"))


def frequent(rows: DataFrame, size: int, known: Filter | None, support: int = SUPPORT, bits: int = BITS) -> DataFrame:
    """(lang, size, key, n, low, high, place) of fingerprints of ``size`` words with ``support`` occurrences.

    No n-gram is frequent unless the two that it consists of are: others are not counted.
    """
    sent = rows.sparkSession.sparkContext.broadcast(None if known is None else (known.bits, known.words))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Fingerprints(bits)
        smaller = Filter(*sent.value) if sent.value else None
        for columns in _gathered(batches):
            batch = batch_of(prints, columns["t"], columns["lang"], size, smaller)
            yield counts_of(batch, np.array(columns["mark"], dtype=np.int64), size)

    counted = rows.mapInArrow(count, "lang string, size int, key long, n long, low long, high long, place long")
    return counted.groupBy("lang", "size", "key").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("place").alias("place")).where(
        (F.col("n") >= support) | (F.col("size") == 0))


def _read(rows: DataFrame, counted: DataFrame, bits: int) -> DataFrame:
    """(lang, size, phrase, a): the words of each fingerprint, read at its occurrence and hashed again.

    The pointers are the least of their phrases, so they lie in few texts, those of small
    marks; only these are shuffled. A text is met once, with all pointers into it, of every size.
    """
    pointers = counted.groupBy(F.shiftright("place", PLACE_BITS).alias("key")).agg(F.collect_list(F.struct(
        "lang", "size", F.col("key"), F.col("n").alias("a"), F.col("place").bitwiseAND(_PLACE).alias("number"))).alias("wanted"))
    pointers = written(pointers, "pointers")
    wanted = filter_of(pointers.select(F.xxhash64("key").alias("key")))
    sent = rows.sparkSession.sparkContext.broadcast((wanted.bits, wanted.words))

    @F.pandas_udf(T.BooleanType())
    def pointed(marks: pd.Series) -> pd.Series:
        return pd.Series(Filter(*sent.value).has(marks.to_numpy().view(np.uint64)))

    kind = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("size", T.IntegerType()),
                                     T.StructField("phrase", T.StringType()), T.StructField("a", T.LongType())]))

    @F.pandas_udf(kind)
    def read(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        prints = Fingerprints(bits)
        for texts, langs, lists in batches:
            yield pd.Series([phrases_at(prints, t, lang, items) for t, lang, items in zip(texts, langs, lists, strict=True)], dtype=object)

    texts = rows.withColumn("key", F.shiftright("mark", PLACE_BITS)).where(pointed(F.xxhash64("key")))
    found = texts.join(pointers, "key").select(F.explode(read("t", "lang", "wanted")).alias("p")).select("p.*")
    return found.distinct()


def phrases_at(prints: Fingerprints, text: str, lang: str, wanted) -> list[dict]:
    """The phrases of a text at the wanted places that have the wanted fingerprints."""
    data = text.encode().translate(_LOWER)
    words, mine = prints.words_of(data), language_hash(lang)
    grams: dict[int, np.ndarray] = {}
    found = []
    for w in wanted:
        size = w["size"]
        if w["lang"] != lang:
            continue
        if size not in grams:
            grams[size] = prints.keys(prints.grams(words.value[0], size), np.uint64(mine)).view(np.int64)
        # a number beyond the pointer's bits starts again at 0
        for k in range(w["number"], len(grams[size]), _PLACE + 1):
            if grams[size][k] == w["key"] and words.piece[k] == words.piece[k + size - 1]:
                phrase = b" ".join(data[words.start[j]:words.end[j]] for j in range(k, k + size)).decode()
                found.append({"lang": lang, "size": size, "phrase": phrase, "a": w["a"]})
                break
    return found


def _recounted(rows: DataFrame, collided: DataFrame, size: int, known: Filter | None, support: int, bits: int) -> DataFrame:
    """(lang, size, phrase, a) of the phrases that share a fingerprint with others, counted by their words."""
    shared = filter_of(collided)
    sent = rows.sparkSession.sparkContext.broadcast((shared.bits, shared.words, known and (known.bits, known.words)))

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Fingerprints(bits)
        b, words, smaller = sent.value
        for columns in _gathered(batches):
            batch = batch_of(prints, columns["t"], columns["lang"], size, smaller and Filter(*smaller))
            kept = np.flatnonzero(Filter(b, words).has(batch.key))
            seen = Counter((batch.languages[batch.row[k]], int(batch.key[k].view(np.int64)), batch.phrase(int(batch.first[k]), size)) for k in kept)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([s[0] for s in seen], pa.string()), "key": pa.array([s[1] for s in seen], pa.int64()),
                "phrase": pa.array([s[2] for s in seen], pa.string()), "a": pa.array(list(seen.values()), pa.int64())})

    texts = rows.mapInArrow(spelled, "lang string, key long, phrase string, a long").groupBy("lang", "key", "phrase").agg(F.sum("a").alias("a"))
    return texts.where(F.col("a") >= support).join(collided, ["lang", "key"], "left_semi").select("lang", F.lit(size).alias("size"), "phrase", "a")


def phrase_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", longest: int = LONGEST,
                  support: int = SUPPORT, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, a) of phrases of up to ``longest`` words with ``support`` occurrences, and (lang, n) of all words.

    Fingerprints whose occurrences differ in the check value are collisions; their
    occurrences are read again and counted by their words.
    """
    rows = _rows(docs, key, text, lang)
    known, clear, found, totals = None, [], [], None
    for size in range(1, longest + 1):
        counted = written(frequent(rows, size, known, support, bits), f"grams{size}")
        if size == 1:
            totals = counted.where("size = 0 AND n > 0").select("lang", "n")
        counted = counted.where(F.col("size") == size)
        clear.append(counted.where("low = high"))
        collided = counted.where("low < high").select("lang", "key")
        if not collided.isEmpty():
            found.append(_recounted(rows, collided, size, known, support, bits))
        known = filter_of(counted) if size < longest else None
    whole = _read(rows, reduce(DataFrame.unionByName, clear), bits)
    return written(reduce(DataFrame.unionByName, found, whole), "phrases"), totals


def _part(words: Column, start: Column | int, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def collocations(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", top: int = TOP,
                 support: int = SUPPORT, bits: int = BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two to four words of each language.

    A phrase counts ``a`` >= ``support`` occurrences within pieces, overlaps included; its score
    is that of its worst cut, the earliest of equal ones. Phrases that lie inside a longer candidate with at
    least 80 % of their occurrences are left out. Ties fall by ``a``, then by the bytes of the phrase.
    Rows that repeat count again, null and empty texts have no words, rows without a language are
    of ``und``; ids may be null or repeat. An empty table gives no rows. Other columns of
    ``docs`` play no part.
    """
    counts, totals = phrase_counts(docs, key, text, lang, support=support, bits=bits)
    candidates = counts.where("size > 1").withColumn("words", F.split("phrase", " "))

    cuts = candidates.select("lang", "phrase", "a", "size", "words", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(F.col("words"), 1, F.col("k")).alias("left"),
                       _part(F.col("words"), F.col("k") + 1, F.col("size")).alias("right"))
    of_left = counts.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    of_right = counts.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
    score = F.expr(f"(cast({SCALE} AS decimal(10, 0)) * cast(a AS decimal(20, 0))) div cast(l + r AS decimal(20, 0))")
    scored = cuts.join(of_left, ["lang", "left"]).join(of_right, ["lang", "right"]).withColumn("score", score)
    worst = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    spans = F.expr("flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), i -> "
                   "array_join(slice(words, i, m), ' '))))")
    inner = candidates.where("size > 2").select("lang", F.explode(spans).alias("phrase"), "a").groupBy("lang", "phrase").agg(
        F.max("a").alias("longer"))
    alone = worst.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * COVERED))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = alone.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
