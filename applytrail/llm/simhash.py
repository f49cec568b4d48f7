"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from applytrail.llm.common import whole_text, written
from applytrail.llm.components import components

WIDTH = 3        # words in a shingle
SEED = 42
DISTANCE = 2     # differing bits that still link
BLOCKS = 4       # blocks a range of bits is cut into: DISTANCE of them may differ, the others agree
CROWDED = 64     # fingerprints in a block above which the block is cut further

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_POWERS = 1 << np.arange(64, dtype=np.uint64)


def shingle_hashes(text: str, width: int = WIDTH) -> list[int]:
    """XXH64 of every word shingle; a text of fewer words has one shingle, an empty one none."""
    words = text.encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: 1 - width].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1:].tolist(), strict=True)]


def fingerprint(text: str, width: int = WIDTH) -> int:
    """The bits set in over half of the shingle hashes, as a signed 64-bit number."""
    hashes = shingle_hashes(text, width)
    if not hashes:
        return 0
    octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BITS for k in range(8)])
    return int(_POWERS[2 * ones > len(hashes)].sum(dtype=np.uint64).astype(np.int64))


@F.pandas_udf(T.LongType())
def _fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(fingerprint)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp): the fingerprint of each row's whole text; null and empty texts have 0."""
    return docs.select(F.col(key).alias("id"), whole_text(text).alias("t")).select("id", _fingerprints("t").alias("fp"))


def _as_long(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def finer_masks(mask: int) -> list[int]:
    """Masks that add all but ``DISTANCE`` blocks of the bits not yet in ``mask``."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [free[len(free) * k // BLOCKS: len(free) * (k + 1) // BLOCKS] for k in range(BLOCKS)]
    return [mask | sum(1 << b for cut in chosen for b in cut)
            for chosen in itertools.combinations(cuts, BLOCKS - DISTANCE)]


def _blocked(rows: DataFrame, masks: Column) -> DataFrame:
    return rows.select("id", "fp", F.explode(masks).alias("mask")).select(
        "id", "fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("block")).distinct()


def close_pairs(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) between ids whose fingerprints differ in at most ``DISTANCE`` bits.

    ``nodes``: (id, fp), one row per distinct fingerprint. The 64 bits are cut into four
    blocks; two close fingerprints agree on at least two of them, so they meet under one of
    six masks. A crowded block is cut again in the same way: after the second cut 56 bits
    are fixed and a block cannot hold more than 256 fingerprints. No block is left out and
    no comparison goes beyond a block.
    """
    parents = [0]
    rows = nodes.select("id", "fp", F.lit(0).cast("long").alias("mask"))
    found = None
    while parents:
        finer = {p: finer_masks(p) for p in parents}
        choice = F.create_map(*[x for p, m in finer.items() for x in (
            F.lit(_as_long(p)), F.array(*[F.lit(_as_long(v)) for v in m]))])
        blocked = _blocked(rows, F.element_at(choice, F.col("mask")))
        sizes = blocked.groupBy("mask", "block").agg(F.count("*").alias("n")).where("n > 1")
        shared = written(blocked.join(sizes, ["mask", "block"]), "blocks")
        parents = sorted({v for m in finer.values() for v in m})
        last = all(bin(p).count("1") >= 56 for p in parents)
        kept = shared if last else shared.where(F.col("n") <= CROWDED)
        left = kept.select("mask", "block", F.col("id").alias("a"), F.col("fp").alias("x"))
        right = kept.select("mask", "block", F.col("id").alias("b"), F.col("fp").alias("y"))
        pairs = left.join(right, ["mask", "block"]).where(
            (F.col("x") < F.col("y")) & (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= DISTANCE)).select("a", "b")
        found = pairs if found is None else found.union(pairs)
        rows = shared.where(F.col("n") > CROWDED).select("id", "fp", "mask")
        if last or rows.isEmpty():
            return found
    return found


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp, component): one row per row of ``docs``.

    ``component`` is the smallest id reachable over links, the row's own id included. Equal
    fingerprints are linked, those of null, empty and wordless texts (0) too. Null ids make
    no links; such rows get the smallest id of their fingerprint's component, or null.
    Rows that repeat an id repeat in the result. Other columns of ``docs`` play no part.
    """
    rows = written(fingerprints(docs, key, text), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("id").alias("id")), "nodes")
    known = nodes.where("id IS NOT NULL")
    roots = components(close_pairs(known))
    reached = nodes.join(roots, nodes["id"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "id").alias("component"))
    return rows.join(reached, "fp").select("id", "fp", "component")


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
