"""SentencePiece encoding and decoding over an Aho-Corasick automaton of the pieces.

One pass over a text: at every position the automaton's output links give the pieces that end
there, and the best segmentation of the text up to that position is settled from the best
ones at the pieces' starts. For a unigram model the best has the largest sum of scores
(Viterbi). For a BPE model sums of scores would be another segmentation than the library's:
there the best is the one piece that merging would leave, that is, the longest one that
holds against the last piece of the segmentation before it. Both give the library's ids.
"""

from __future__ import annotations

import re
import struct
import sys
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from types import ModuleType

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from applytrail.llm.common import whole_text

SPACE = "▁"
CACHE_SIZE = 400_000  # stretches a task remembers; a full cache starts anew
LONGEST = 32          # characters of a stretch that is remembered
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and values of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        elif tag & 7 == 2:
            size = varint()
            yield tag >> 3, data[at:at + size]
            at += size
        else:
            size = 4 if tag & 7 == 5 else 8
            yield tag >> 3, struct.unpack("<f" if size == 4 else "<d", data[at:at + size])[0]
            at += size


@dataclass
class Pieces:
    """A model file's pieces with their scores and kinds, and how texts are normalised."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    model: int = UNIGRAM
    prefix: bool = True
    squeeze: bool = True
    escape: bool = True
    charsmap: bool = False

    @classmethod
    def read(cls, data: bytes) -> Pieces:
        out = cls([], [], [])
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                out.pieces.append(piece.get(1, b"").decode("utf-8"))
                out.scores.append(float(piece.get(2, 0.0)))
                out.kinds.append(int(piece.get(3, NORMAL)))
            elif number == 2:
                out.model = int(dict(_fields(value)).get(3, UNIGRAM))
            elif number == 3:
                rules = dict(_fields(value))
                out.charsmap = bool(rules.get(2, b""))
                out.prefix, out.squeeze, out.escape = (bool(rules.get(k, 1)) for k in (3, 4, 5))
        if out.charsmap:
            raise ValueError("models with a character map need its normaliser; this one reads identity models")
        return out


class Codec:
    """Encodes and decodes with one model. ``encode(text)`` gives ids, ``decode(ids)`` a text."""

    def __init__(self, model: Pieces) -> None:
        self.model = model
        usable = (NORMAL, USER)
        self.ids = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k in usable}
        self.octets = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k == BYTE}
        self.unknown = next((i for i, k in enumerate(model.kinds) if k == UNKNOWN), 0)
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.automaton.add_word(p, (len(p), i))
        if self.ids:
            self.automaton.make_automaton()
        self.floor = min((s for s, k in zip(model.scores, model.kinds, strict=True) if k == NORMAL), default=0.0) - 10.0
        self.rank = {p: -model.scores[i] for p, i in self.ids.items()}
        self.holds: dict[int, bool] = {}
        self.cache: dict[str, bytes] = {}
        # where no piece has a blank after another character, nor an ASCII mark or digit after a
        # Latin letter, a text can be cut there: the stretches are encoded by themselves
        mark, latin = r"\x00-@\[-`{-\x7f", "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
        crossing = re.compile(f"[^{SPACE}]{SPACE}|[{latin}][{mark}]")
        self.cut = None if any(k == USER for k in model.kinds) or any(crossing.search(p) for p in self.ids) else re.compile(
            f"{SPACE}*+(?:[^{latin}{SPACE}]++|[{latin}]++(?=[^{mark}{SPACE}]))*+[{latin}]*")
        self.plain = [p.replace(SPACE, " ").encode() if k in usable else b"" for p, k in zip(model.pieces, model.kinds, strict=True)]
        for octet, i in self.octets.items():
            self.plain[i] = bytes([octet])
        self.plain[self.unknown] = " ⁇ ".encode()

    def normal(self, text: str) -> str:
        if self.model.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if text and self.model.prefix:
            text = " " + text
        return text.replace(" ", SPACE) if self.model.escape else text

    def _left_whole(self, last: str, piece: str) -> bool:
        """Whether merging the characters of two pieces leaves these two: no merge joins one's end to the other's start.

        The best-scored neighbours are merged first, the left ones on a tie.
        """
        rank, never = self.rank, np.inf
        parts, border = [*last, *piece], len(last)
        ranks = [rank.get(a + b, never) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best is never:
                break
            k = ranks.index(best)
            if k + 1 == border:
                return False
            border -= k < border
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank.get(parts[k - 1] + parts[k], never)
            if k < len(ranks):
                ranks[k] = rank.get(parts[k] + parts[k + 1], never)
        return len(parts) == (2 if last else 1)

    def _holds(self, last: int, piece: int) -> bool:
        """Whether merging leaves a piece, and the one before it, as they are; -1 is no piece at all."""
        pieces = self.model.pieces
        known = self._left_whole(pieces[last] if last >= 0 else "", pieces[piece])
        if len(self.holds) > 1_000_000:
            self.holds.clear()
        self.holds[last << 32 | piece] = known
        return known

    def segment(self, text: str) -> list[int]:
        """Ids of a normalised stretch, by one pass of the automaton."""
        n = len(text)
        last = [-1] * (n + 1)       # the piece that ends at a position, -1 where a character has none
        start = list(range(-1, n))  # and where it starts
        if self.model.model == BPE:
            # the automaton gives the pieces that end at a position longest first; a stretch
            # begins afresh behind a character without a piece
            holds = self.holds
            for end, (size, piece) in self.automaton.iter(text) if self.ids else ():
                if last[end + 1] < 0:
                    before = last[end + 1 - size]
                    known = holds.get(before << 32 | piece)
                    if self._holds(before, piece) if known is None else known:
                        last[end + 1], start[end + 1] = piece, end + 1 - size
        else:
            ending: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]
            for end, found in self.automaton.iter(text) if self.ids else ():
                ending[end + 1].append(found)
            best = [0.0] + [0.0] * n
            scores, kinds = self.model.scores, self.model.kinds
            top = max(scores, default=0.0)
            for at in range(1, n + 1):
                value, single = -np.inf, False
                for size, piece in ending[at]:
                    single |= size == 1
                    own = size * top - 0.1 if kinds[piece] == USER else scores[piece]
                    if best[at - size] + own > value:
                        value, last[at], start[at] = best[at - size] + own, piece, at - size
                if not single and best[at - 1] + self.floor > value:
                    value, last[at], start[at] = best[at - 1] + self.floor, -1, at - 1
                best[at] = value
        out: list[int] = []
        at = n
        while at > 0:
            if last[at] >= 0:
                out.append(last[at])
            elif self.octets:
                out.extend(self.octets[b] for b in reversed(text[start[at]:at].encode("utf-8", "replace")))
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)  # neighbours without a piece are one unknown
            at = start[at]
        return out[::-1]

    def packed(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit numbers."""
        text = self.normal(text)
        if self.cut is None or not self.octets:
            return np.array(self.segment(text), dtype="<i4").tobytes()
        cache = self.cache
        stretches = self.cut.findall(text)
        missing = {s for s in stretches if s not in cache}
        if not missing:
            return b"".join(map(cache.__getitem__, stretches))
        new = {s: array("i", self.segment(s)).tobytes() for s in missing}
        out = b"".join([new[s] if s in new else cache[s] for s in stretches])
        if len(cache) + len(new) > CACHE_SIZE:
            cache.clear()
        cache.update((s, ids) for s, ids in new.items() if len(s) <= LONGEST)
        return out

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), dtype="<i4").tolist()

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.plain.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.model.prefix and text.startswith(" ") else text


def _resident(data: bytes) -> Codec:
    """The codec of a model, kept by the worker process: what one task has worked out, the next need not.

    The package travels by value, so its own modules start anew in each task; a module of the
    process holds one codec, that of the last model.
    """
    kept = sys.modules.setdefault("applytrail_resident_codec", ModuleType("applytrail_resident_codec"))
    if getattr(kept, "model", None) != data:
        kept.model, kept.codec = data, Codec(Pieces.read(data))
    return kept.codec


def _shipped(docs: DataFrame, path: str):
    with open(path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def ids_of(docs: DataFrame, path: str, text: str = "text") -> Column:
    """Ids of the whole text under the model file at ``path``; a null or empty text has none."""
    data = _shipped(docs, path)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _resident(data.value)
        for texts in batches:
            yield pd.Series([np.frombuffer(codec.packed(t), dtype="<i4") for t in texts])
    return encode(whole_text(text))


def text_of(docs: DataFrame, path: str, ids: str = "ids") -> Column:
    """The text that ids stand for; null ids count as none, ids outside the model fail the job."""
    data = _shipped(docs, path)

    @F.pandas_udf(T.StringType())
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _resident(data.value)
        for rows in batches:
            yield pd.Series([codec.decode(r.tolist()) if r is not None else "" for r in rows])
    return decode(F.col(ids))


def encoded(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids): one row per row of ``docs``; ids may be null or repeat, other columns are left out."""
    return docs.select(F.col(key).alias("id"), ids_of(docs, path, text).alias("ids"))
