"""Benchmark decontamination: which short test items lie inside which long documents.

Items are partitioned by size: a class holds the items whose number of distinct shingles has
the same binary length, so they differ by less than a factor of two. A document contains an
item of n shingles if at least ``ceil(threshold * n)`` of them are there, so at most
``n - ceil(threshold * n)`` are missing. The sketch of an item is its k smallest shingle
hashes (bottom-k MinHash), k fixed by the class: one more than its largest item may miss. Of
a sketch of k hashes at least ``k - missing`` must then be in a document that contains the
item, at least one; that count makes a candidate, and exact shingles verify it. A document
with fewer windows than the smallest item of a class needs skips the class. No link is lost.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from applytrail.llm.common import shipped, whole_text, written

WIDTH = 5                # words in a shingle
THRESHOLD = 0.8          # share of an item's distinct shingles that makes it contained
BLOCK_CHARS = 4_000_000  # item text searched in one pass; more items take more passes

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    """Words between white space, A-Z in lower case, without punctuation at their ends."""
    return [w for w in (x.strip(b".,;:!?\"'()[]{}|#*$%&<>") for x in
                        text.encode("utf-8", "replace").translate(_LOWER).split()) if w]


def _hashed(columns: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of each row of word numbers."""
    h = np.full(len(columns[0]), len(columns), dtype=np.uint64)
    for c in columns:
        h = (h ^ c.astype(np.uint64)) * _MIX
        h ^= h >> np.uint64(29)
    return h


@dataclass
class SizeClass:
    """Items of one size class and shingle width: the partition that is searched as one.

    ``sketch`` maps hashes to the items that have them in their sketch, ``smallest`` is the
    least number of shingles a document needs to contain any of the items.
    """

    smallest: int
    sketch: dict[int, list[int]]


@dataclass
class Items:
    """A block of items, ready to be searched for.

    ``shingles`` holds every item's distinct shingles as tuples of word numbers, ``least`` the
    sketch hashes that must be found to make it a candidate, ``classes`` the size classes of
    each shingle width. An item shorter than ``width`` words has one shingle: all its words in
    order. Items without words are contained nowhere.
    """

    ids: list
    numbers: dict[bytes, int] = field(default_factory=dict)
    shingles: list[set[tuple[int, ...]]] = field(default_factory=list)
    least: list[int] = field(default_factory=list)
    classes: dict[int, list[SizeClass]] = field(default_factory=dict)

    @classmethod
    def of(cls, rows: Iterable[tuple[object, str]], width: int, threshold: float) -> Items:
        rows = list(rows)
        items = cls([i for i, _ in rows], least=[0] * len(rows))
        members: dict[tuple[int, int], list[int]] = defaultdict(list)
        for place, (_, text) in enumerate(rows):
            w = [items.numbers.setdefault(x, len(items.numbers)) for x in words_of(text)]
            k = min(width, len(w))
            own = _distinct(w, width)
            items.shingles.append(own)
            if own:
                members[k, size_class(len(own))].append(place)
        items.classes = {k: [] for k, _ in sorted(members)}
        for (k, _), places in sorted(members.items()):
            items.classes[k].append(items._partition(k, places, threshold))
        return items

    def _partition(self, width: int, places: list[int], threshold: float) -> SizeClass:
        """The class of the items at ``places``; sets how many sketch hashes each must show."""
        sizes = [len(self.shingles[p]) for p in places]
        length = max(n - needed(n, threshold) for n in sizes) + 1
        sketch: dict[int, list[int]] = defaultdict(list)
        for place, n in zip(places, sizes, strict=True):
            grid = np.array(sorted(self.shingles[place]), dtype=np.int64)
            hashes = np.sort(_hashed([grid[:, c] for c in range(width)]))[:length]
            self.least[place] = len(hashes) - (n - needed(n, threshold))
            for h in hashes.tolist():
                sketch[h].append(place)
        return SizeClass(min(needed(n, threshold) for n in sizes), dict(sketch))

    def ready(self) -> Items:
        self.values = {k: np.array(sorted(set().union(*[c.sketch for c in classes])), dtype=np.uint64)
                       for k, classes in self.classes.items()}
        return self

    def contained_in(self, text: str, threshold: float) -> list[tuple[object, int, int]]:
        """(item id, shingles found, shingles of the item) of every item that ``text`` contains."""
        found = []
        number = self.numbers.get
        w = np.array([number(x, -1) for x in words_of(text)], dtype=np.int64)
        unknown = np.concatenate([[0], np.cumsum(w < 0)])
        for k, values in self.values.items():
            if len(w) < k:
                continue
            at = np.flatnonzero(unknown[k:] == unknown[:-k])  # windows of words that items have
            if not len(at):
                continue
            hashes = _hashed([w[at + c] for c in range(k)])
            place = np.minimum(np.searchsorted(values, hashes), len(values) - 1)
            hits = set(hashes[values[place] == hashes].tolist())
            candidates = self._candidates(k, hits, len(at))
            if candidates:
                here = set(map(tuple, np.stack([w[at + c] for c in range(k)], axis=1).tolist()))
                for i in candidates:
                    n, shared = len(self.shingles[i]), len(self.shingles[i] & here)
                    if shared >= needed(n, threshold):
                        found.append((self.ids[i], shared, n))
        return found

    def _candidates(self, width: int, hits: set[int], windows: int) -> list[int]:
        """Items of which a document's ``hits`` hold enough of the sketch, class by class."""
        enough = []
        for part in self.classes[width] if hits else []:
            if windows >= part.smallest:
                seen = Counter(i for h in hits for i in part.sketch.get(h, ()))
                enough += [i for i, n in seen.items() if n >= self.least[i]]
        return sorted(enough)


def size_class(n: int) -> int:
    """The class of an item of ``n`` shingles: n lies in [2 ** (class - 1), 2 ** class)."""
    return n.bit_length()


def needed(n: int, threshold: float) -> int:
    """Shingles of ``n`` that make containment; the small term keeps 0.8 * 5 at 4."""
    return max(1, math.ceil(threshold * n - 1e-9))


def sized(items: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(id, t, class, place): the items that have words, with size class and a row number, written once."""
    @F.pandas_udf(T.IntegerType())
    def classes(texts: pd.Series) -> pd.Series:
        return pd.Series([size_class(len(_distinct(words_of(t), width))) for t in texts], dtype="int32")

    rows = items.select(F.col(key).alias("id"), whole_text(text).alias("t"))
    rows = rows.select("*", classes("t").alias("class"), F.monotonically_increasing_id().alias("place"))
    return written(rows, "items").where("class > 0")


def _distinct(words: list, width: int) -> set[tuple]:
    """The shingles of ``words``; fewer than ``width`` words make one."""
    k = min(width, len(words))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set()


def block_plan(chars: list[tuple[int, int]], block_chars: int) -> list[list[tuple[int, int, int]]]:
    """Blocks of (class, slice, slices) from the characters of each class, smallest class first.

    A class above ``block_chars`` is dealt into slices, each a block of its own; smaller ones
    share blocks as long as they fit.
    """
    plan: list[list[tuple[int, int, int]]] = []
    room = 0
    for c, size in sorted(chars):
        slices = max(1, math.ceil(size / block_chars))
        if slices == 1 and size <= room:
            plan[-1].append((c, 0, 1))
            room -= size
        else:
            plan += [[(c, s, slices)] for s in range(slices)]
            room = block_chars - size if slices == 1 else 0
    return plan


def item_blocks(items: DataFrame, key: str, text: str, width: int, threshold: float, block_chars: int) -> Iterator[tuple[Items, bool]]:
    """The items in blocks of about ``block_chars`` characters, and whether a block is the only one.

    Sizes are counted in tasks; the driver sees the sums of the classes and one block at a
    time. Items of a class differ little in length, so slices dealt by a hash of the row come
    out even; a single item longer than a block makes its block as long.
    """
    rows = sized(items, key, text, width)
    chars = rows.groupBy("class").agg(F.sum(F.length("t")).alias("chars")).collect()
    plan = block_plan([(r["class"], r["chars"]) for r in chars], block_chars)
    for parts in plan:
        mine = F.lit(False)
        for c, s, slices in parts:
            mine = mine | ((F.col("class") == c) & (F.pmod(F.xxhash64("place"), F.lit(slices)) == s))
        block = [(r["id"], r["t"]) for r in rows.where(mine).orderBy("place").collect()]
        yield Items.of(block, width, threshold), len(plan) == 1


def contained(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
              item_text: str = "text", width: int = WIDTH, threshold: float = THRESHOLD,
              block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, item_id, shared, shingles, containment): items contained in documents.

    One row per pair of a row of ``docs`` and a row of ``items``; rows that repeat on either
    side repeat in the result. Null and wordless texts, of either side, make no pair; ids may
    be null. The items are the query set: they are searched for in blocks of one or more size
    classes and about ``block_chars`` characters, one block after another, each broadcast (so of
    bounded size) and looked up in one pass over the documents, without a shuffle. The pairs of
    a block are written before the next one is built, unless it is the only one.
    """
    spark = docs.sparkSession
    kinds = dict(docs.dtypes)[key], dict(items.dtypes)[item_key]
    schema = f"id {kinds[0]}, item_id {kinds[1]}, shared int, shingles int"
    rows = docs.select(F.col(key).alias("id"), whole_text(text).alias("t"))
    found = spark.createDataFrame([], schema)
    for block, only in item_blocks(items, item_key, item_text, width, threshold, block_chars):
        part = rows.mapInPandas(_pairs(shipped(spark, block), threshold), schema)
        found = part if only else found.union(written(part, "contained"))
    return found.withColumn("containment", F.col("shared") / F.col("shingles"))


def _pairs(block_items: Callable[[], Items], threshold: float):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready = block_items().ready()
        for batch in batches:
            hits = [(i, *hit) for i, t in zip(batch["id"], batch["t"], strict=True)
                    for hit in ready.contained_in(t, threshold)]
            yield pd.DataFrame(hits, columns=["id", "item_id", "shared", "shingles"]).astype(object)
    return search


def without_contained(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id",
                      item_text: str = "text", width: int = WIDTH, threshold: float = THRESHOLD,
                      block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` whose text contains no item; null and wordless texts contain none.

    Rows keep their columns, null ids and repeats; without items all stay. Blocks of items are
    taken in turn, and what one leaves is written before the next one is built.
    """
    for block, only in item_blocks(items, item_key, item_text, width, threshold, block_chars):
        clean = docs.where(~_holds_item(shipped(docs.sparkSession, block), threshold)(whole_text(text)))
        docs = clean if only else written(clean, "decontaminated")
    return docs


def contains_any(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
                 width: int = WIDTH, threshold: float = THRESHOLD, block_chars: int = BLOCK_CHARS) -> Column:
    """Whether a row's text contains an item; false for null texts and without items.

    A column needs all blocks at once: for item sets of a few blocks. ``without_contained``
    takes any number of them in turn.
    """
    found = F.lit(False)
    for block, _ in item_blocks(items, item_key, item_text, width, threshold, block_chars):
        found = found | _holds_item(shipped(docs.sparkSession, block), threshold)(whole_text(text))
    return found


def _holds_item(block_items, threshold: float):
    @F.pandas_udf(T.BooleanType())
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ready = block_items().ready()
        for texts in batches:
            yield pd.Series([bool(ready.contained_in(t, threshold)) for t in texts], dtype=bool)
    return search
