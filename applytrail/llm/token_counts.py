"""Token counts by a two-tier lookup of pre-token lengths.

A pre-token here is a run without white space: the library never merges across white space,
so a text has as many tokens as its runs have together. Frequent runs are looked up in a
broadcast table of bounded size; other runs are encoded once per task by the library and
remembered. Nothing is shuffled.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from applytrail.llm.common import sampled, whole_text

LIMIT = 2048            # tokens above which a text is marked
SAMPLE_ROWS = 4000      # rows, about, that choose the frequent runs; affects speed alone
TABLE_SIZE = 50_000     # entries of the broadcast table
LONGEST = 32            # code points of a run kept in the table or the cache
ENCODED_AT_ONCE = 500
CACHE_SIZE = 200_000    # entries of a task's cache; a full cache starts anew

# the library's white space, and the characters only Python's split() takes for white space
WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
PYTHON_ONLY = re.compile(r"[\x1c-\x1f]")


def runs(text: str) -> list[str]:
    if PYTHON_ONLY.search(text):
        return [r for r in WHITE.split(text) if r]
    return text.split()


def _lengths(tokenizer: Tokenizer, chunks: list[str]) -> list[int]:
    # a task has one core; encodings are large, so only a few are held at a time
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return [len(e.ids) for at in range(0, len(chunks), ENCODED_AT_ONCE)
            for e in tokenizer.encode_batch_fast(chunks[at:at + ENCODED_AT_ONCE], add_special_tokens=False)]


def _load(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@dataclass
class Counts:
    """Counts tokens of texts; ``table`` maps frequent runs to their number of tokens."""

    tokenizer: Tokenizer
    table: dict[str, int]

    def __post_init__(self) -> None:
        self.cache: dict[str, int] = {}

    def batch(self, texts: list[str]) -> list[int]:
        split = [runs(t) for t in texts]
        table, cache = self.table, self.cache
        missing = list({r for row in split for r in set(row) if r not in table and r not in cache})
        lengths = dict(zip(missing, _lengths(self.tokenizer, missing), strict=True))
        both = {**lengths, **table} if not cache else None
        out = []
        for row in split:
            if both is not None:
                out.append(sum(map(both.__getitem__, row)))
            else:
                out.append(sum([n if (n := table.get(r)) is not None else m if (m := cache.get(r)) is not None
                                else lengths[r] for r in row]))
        if len(cache) + len(lengths) > CACHE_SIZE:
            cache.clear()
        cache.update((r, n) for r, n in lengths.items() if len(r) <= LONGEST)
        return out


def frequent_runs(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS,
                  size: int = TABLE_SIZE) -> dict[str, int]:
    """The commonest runs of a sample with their lengths: at most ``size``, of at most ``LONGEST`` code points.

    The sampled texts are counted where they lie; only runs and their counts are grouped.
    """
    def commonest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for t in batch["t"]:
                seen.update(r for r in runs(t) if len(r) <= LONGEST)
            if len(seen) > 8 * size:
                seen = Counter(dict(seen.most_common(2 * size)))
        yield pd.DataFrame(seen.most_common(size), columns=["run", "n"])

    sample = sampled(docs, sample_rows, key).select(whole_text(text).alias("t"))
    rows = sample.mapInPandas(commonest, "run string, n long").groupBy("run").agg(F.sum("n").alias("n")).orderBy(
        F.desc("n"), "run").limit(size).collect()
    chosen = [r["run"] for r in rows]
    return dict(zip(chosen, _lengths(_load(path), chosen), strict=True))


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit): one row per row of ``docs``, other columns left out.

    Null and empty texts have no tokens; ids may be null or repeat. ``path`` is a vocabulary
    file of the ``tokenizers`` library whose pre-tokenizer breaks at white space.
    """
    table = docs.sparkSession.sparkContext.broadcast(frequent_runs(docs, path, key, text))
    with open(path, encoding="utf-8") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = Tokenizer.from_str(vocabulary.value)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        counts = Counts(tokenizer, table.value)
        for texts in batches:
            yield pd.Series(counts.batch(texts.tolist()), dtype="int64")

    rows = docs.select(F.col(key).alias("id"), whole_text(text).alias("t"))
    counted = rows.select("id", F.octet_length("t").cast("long").alias("n_bytes"), count("t").alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
