"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram's vector is the product of its
letters' vectors, the first rotated by two places, the second by one. A text is the sum of its
trigrams' vectors; a language is the sum of its training texts' unit vectors. A text has
the language whose vector has the largest cosine with its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from applytrail.llm.common import shipped, whole_text, written

DIMENSIONS = 1024
SYMBOLS = 64             # blank, 47 letters of their own, 16 shared by all other letters
OWN_LETTERS = 47
ROWS_PER_LANGUAGE = 800  # training rows of a language
LANGUAGES = 8192         # languages learned, the commonest first: more than have a code of three letters
SHARPNESS = 12.0         # of the score's softmax over cosines
UNKNOWN = "und"


def _letters(text: str) -> np.ndarray:
    """Code points of the text in lower case, with 32 for every character that is no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
    return np.where(_is_letter()[np.minimum(points, 0x10FFFF)], points, 32)


_table: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _table:
        _table.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _table[0]


@dataclass
class Space:
    """The alphabet's symbols and their vectors."""

    own: list[int]  # code points with a symbol of their own

    def ready(self) -> Space:
        rng = np.random.default_rng(20240131)
        base = rng.choice(np.array([-1, 1], dtype=np.int8), size=(SYMBOLS, DIMENSIONS))
        self.first, self.second, self.third = np.roll(base, 2, axis=1), np.roll(base, 1, axis=1), base
        symbol = (OWN_LETTERS + 1 + np.arange(0x110000) % (SYMBOLS - OWN_LETTERS - 1)).astype(np.int32)
        symbol[32] = 0
        symbol[np.array(self.own, dtype=np.int64)] = 1 + np.arange(len(self.own))
        self.symbol = symbol
        return self

    def codes(self, text: str) -> np.ndarray:
        """Trigram codes of a text's letters, runs of other characters counting as one blank."""
        s = self.symbol[_letters(text)]
        s = np.concatenate([[0], s, [0]])
        s = s[np.concatenate([[True], (s[1:] != 0) | (s[:-1] != 0)])]
        if len(s) < 3:
            return np.empty(0, dtype=np.int64)
        return (s[:-2].astype(np.int64) * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:]

    def vectors(self, texts: list[str]) -> np.ndarray:
        """The unit vector of each text, zero for a text without letters."""
        counted = [np.bincount(c, minlength=1) if len(c) else np.zeros(1, dtype=np.int64)
                   for c in map(self.codes, texts)]
        used = [np.flatnonzero(c) for c in counted]
        columns = np.unique(np.concatenate(used)) if used else np.empty(0, dtype=np.int64)
        grid = np.zeros((len(texts), len(columns)), dtype=np.float32)
        for row, (c, u) in enumerate(zip(counted, used, strict=True)):
            grid[row, np.searchsorted(columns, u)] = c[u]
        bound = self.first[columns // SYMBOLS ** 2] * self.second[columns // SYMBOLS % SYMBOLS] * self.third[columns % SYMBOLS]
        bundled = grid @ bound.astype(np.float32)
        length = np.linalg.norm(bundled, axis=1, keepdims=True)
        return np.divide(bundled, length, out=np.zeros_like(bundled), where=length > 0)


@dataclass
class Profiles:
    space: Space
    languages: list[str]
    prototypes: np.ndarray  # a unit vector for each language

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """The language of each text and its share of a softmax over cosines; ``und`` scores 0."""
        out: list[tuple[str, float]] = []
        for start in range(0, len(texts), 64):
            rows = self.space.vectors(texts[start:start + 64])
            if not self.languages:
                out.extend((UNKNOWN, 0.0) for _ in rows)
                continue
            cosines = rows @ self.prototypes.T
            weight = np.exp(SHARPNESS * (cosines - cosines.max(axis=1, keepdims=True)))
            best = cosines.argmax(axis=1)
            known = np.abs(rows).sum(axis=1) > 0
            out.extend((self.languages[b], float(w[b] / w.sum())) if k else (UNKNOWN, 0.0)
                       for b, w, k in zip(best, weight, known, strict=True))
        return out


def training_rows(docs: DataFrame, learn: Column, rows: int = ROWS_PER_LANGUAGE, languages: int = LANGUAGES,
                  key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, t): of each language the ``rows`` texts with the smallest hashes of id and text.

    The choice is the same whatever the layout. Rows without an id count like others, those
    that share one are told apart by their texts, and equal rows count once, so ``rows *
    languages`` bounds the result. Hashes alone are ranked; a language's last hash, broadcast,
    then picks its texts from the scan.
    """
    usable = docs.where(learn & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.xxhash64(F.col(key), F.col(text)).alias("hash"), F.col(text).alias("t"))
    sizes = usable.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("hash").alias("texts")).orderBy(
        F.desc("n"), "lang").limit(languages)
    # about twice as many hashes as wanted are ranked, however many rows a language or a task has
    place = F.col("hash") / F.lit(2.0 ** 64) + 0.5
    near = usable.select("lang", "hash").join(F.broadcast(sizes), "lang").where(
        place <= 2.0 * rows / F.col("texts")).select("lang", "hash").distinct()
    ranked = near.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("hash")))
    last = ranked.where(F.col("place") <= rows).groupBy("lang").agg(F.max("hash").alias("last"))
    return usable.join(F.broadcast(last), "lang").where("hash <= last").groupBy("lang", "hash").agg(
        F.min("t").alias("t")).select("lang", "t")


def learn_profiles(rows: DataFrame) -> Profiles:
    """Prototypes from (lang, t) rows: letters are counted and texts bundled in the executors."""
    def letters(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = np.concatenate([_letters(t) for t in batch["t"]] or [np.empty(0, dtype=np.uint32)])
            seen, n = np.unique(points[points != 32], return_counts=True)
            yield pd.DataFrame({"point": seen.astype("int64"), "n": n})

    rows = written(rows, "language-rows")
    commonest = rows.select("t").mapInPandas(letters, "point long, n long").groupBy("point").agg(
        F.sum("n").alias("n")).orderBy(F.desc("n"), "point").limit(OWN_LETTERS).collect()
    space = Space([r["point"] for r in commonest])

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        space.ready()
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for start in range(0, len(batch), 64):
                part = batch[start:start + 64]
                for language, v in zip(part["lang"], space.vectors(part["t"].tolist()), strict=True):
                    sums[language] = sums.get(language, 0) + v.astype(np.float64)
        if sums:
            yield pd.DataFrame({"lang": list(sums), "v": [v.tolist() for v in sums.values()]})

    sums: dict[str, np.ndarray] = {}
    # one task a language: at most ``rows`` texts, and one vector comes back
    bundled = rows.repartition("lang").mapInPandas(bundle, "lang string, v array<double>")
    for r in sorted(bundled.collect(), key=lambda r: (r["lang"], r["v"])):
        sums[r["lang"]] = sums.get(r["lang"], 0) + np.array(r["v"])
    usable = {k: v / np.linalg.norm(v) for k, v in sorted(sums.items()) if np.linalg.norm(v) > 0}
    stacked = np.array(list(usable.values()), dtype=np.float32) if usable else np.zeros((0, DIMENSIONS), np.float32)
    return Profiles(space, list(usable), stacked)


def identify(docs: DataFrame, profiles: Profiles, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, lang_pred, score): one row per row of ``docs``, other columns left out.

    A null text, or one without a letter, is ``und`` with score 0; so is every text if no
    language was learned. Ids may be null or repeat. Ties go to the first language by name.
    """
    told = shipped(docs.sparkSession, profiles)
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(kind)
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = told()
        known.space.ready()
        for texts in batches:
            yield pd.DataFrame(known.predict(texts.tolist()), columns=["lang_pred", "score"])

    rows = docs.select(F.col(key).alias("id"), whole_text(text).alias("t"))
    return rows.select("id", predicted("t").alias("p")).select("id", "p.lang_pred", "p.score")
