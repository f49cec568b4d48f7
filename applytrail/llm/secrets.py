"""Secret scan: fixed patterns, and formats inferred from the credentials they find.

Credentials found by the patterns are the labelled examples. For each kind a prefix tree of
their characters' classes is merged state by state wherever two states' next-character
frequencies are statistically compatible (Hoeffding bound); the result is a probabilistic
automaton. Of credentials only states of the same depth are merged, so states with too few
examples to tell apart keep place and length, the most of what a format is. A further
automaton, with merging across depths, learns ordinary tokens. Every token of a text that is as
long as credentials are is scored by how much likelier it is, per character, under a
credential automaton than under the ordinary one.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from applytrail.llm.common import shipped, whole_text

ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs of the class are maximal: those of 24 and more
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{6,}")
KINDS = ("assign", "access", "hex", "inferred")
NEEDLES = ("password", "passwd", "secret", "token", "api")

EXAMPLES = 400       # strings of a kind that an automaton is learned from, those of the smallest hashes
ORDINARY = 1600      # ordinary tokens likewise
LONGEST = 256        # characters of a string that is learned from
SHORTEST = 16        # characters from which tokens are scored; fewer if a credential found has fewer
CONFIDENCE = 0.05    # of the compatibility test
MARGIN = 0.25        # nats a character by which a token must beat every ordinary token learned from
LEAST = 0.5          # nats a character that a token needs at least

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Pattern matches, start and exclusive end in code points, by start and then kind."""
    found: list[Span] = []
    lowered = text.lower()
    if any(n in lowered for n in NEEDLES):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def credentials(text: str) -> list[tuple[str, str]]:
    """(kind, secret) of every pattern match: an assignment's value, otherwise all of it."""
    return [(k, ASSIGN.fullmatch(text, a, b)[2] if k == "assign" else text[a:b]) for k, a, b in base_spans(text)]


def candidates(text: str, spans: list[Span], shortest: int = SHORTEST) -> list[tuple[int, int]]:
    """Tokens of a length that no span touches."""
    return [m.span() for m in TOKEN.finditer(text) if m.end() - m.start() >= shortest
            and not any(a < m.end() and m.start() < b for _, a, b in spans)]


def examples_of(text: str) -> set[tuple[str, str]]:
    """(kind, string) of the credentials of a text, and of its other tokens as kind ``ordinary``."""
    spans = base_spans(text)
    found = {(k, ASSIGN.fullmatch(text, a, b)[2] if k == "assign" else text[a:b]) for k, a, b in spans}
    found |= {("ordinary", text[a:b]) for a, b in candidates(text, spans, 6)}
    return {(k, x) for k, x in found if len(x) <= LONGEST}


_CLASSES = {**dict.fromkeys("0123456789", "d"), **dict.fromkeys("abcdef", "h"), **dict.fromkeys("ABCDEF", "H"),
            **dict.fromkeys("ghijklmnopqrstuvwxyz", "l"), **dict.fromkeys("GHIJKLMNOPQRSTUVWXYZ", "L")}
_TO_CLASS = str.maketrans(_CLASSES)
_FLOOR = 1e-3  # probability of a step that was never seen


@dataclass
class Automaton:
    """A probabilistic automaton over character classes, learned by merging prefix-tree states."""

    next: list[dict[str, int]] = field(default_factory=lambda: [{}])
    count: list[dict[str, int]] = field(default_factory=lambda: [{}])
    ends: list[int] = field(default_factory=lambda: [0])

    @classmethod
    def learn(cls, strings: list[str], confidence: float = CONFIDENCE, by_depth: bool = False) -> Automaton:
        """``by_depth`` merges states of one depth only: the automaton has no cycles and keeps lengths."""
        tree = cls()
        for s in sorted(strings, key=lambda s: (len(s), s)):
            at = 0
            for c in s:
                tree.count[at][c] = tree.count[at].get(c, 0) + 1
                if c not in tree.next[at]:
                    tree.next[at][c] = len(tree.next)
                    tree.next.append({})
                    tree.count.append({})
                    tree.ends.append(0)
                at = tree.next[at][c]
            tree.ends[at] += 1
        width = math.sqrt(0.5 * math.log(2 / confidence))
        if by_depth:
            tree._merge_depths(width)
        else:
            tree._merge_all(width)
        return tree

    def _total(self, q: int) -> int:
        return self.ends[q] + sum(self.count[q].values())

    def _compatible(self, a: int, b: int, width: float) -> bool:
        """No frequency of the two states, or of the states after them, differs too much."""
        waiting = [(a, b)]
        while waiting:
            a, b = waiting.pop()
            n, m = self._total(a), self._total(b)
            if not n or not m:
                continue
            bound = width * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ends[a] / n - self.ends[b] / m) > bound:
                return False
            for c in {*self.count[a], *self.count[b]}:
                if abs(self.count[a].get(c, 0) / n - self.count[b].get(c, 0) / m) > bound:
                    return False
            waiting += [(self.next[a][c], self.next[b][c]) for c in self.next[a] if c in self.next[b]]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below ``b`` to the states at and after ``a``."""
        waiting = [(a, b)]
        while waiting:
            a, b = waiting.pop()
            self.ends[a] += self.ends[b]
            for c, n in self.count[b].items():
                self.count[a][c] = self.count[a].get(c, 0) + n
                if c in self.next[a]:
                    waiting.append((self.next[a][c], self.next[b][c]))
                else:
                    self.next[a][c] = self.next[b][c]

    def _merge_all(self, width: float) -> None:
        settled = [0]
        while True:
            known = set(settled)
            border = [(q, c) for q in settled for c in sorted(self.next[q]) if self.next[q][c] not in known]
            if not border:
                return
            q, c = max(border, key=lambda e: self.count[e[0]][e[1]])
            new = self.next[q][c]
            for old in settled:
                if self._compatible(old, new, width):
                    self.next[q][c] = old
                    self._fold(old, new)
                    break
            else:
                settled.append(new)

    def _merge_depths(self, width: float) -> None:
        level = [0]
        while level:
            edges = sorted(((q, c) for q in level for c in self.next[q]), key=lambda e: (-self.count[e[0]][e[1]], e))
            level = []
            for q, c in edges:
                new = self.next[q][c]
                for old in level:
                    if old == new:
                        break
                    if self._compatible(old, new, width):
                        self.next[q][c] = old
                        self._fold(old, new)
                        break
                else:
                    level.append(new)

    def states(self) -> int:
        """Number of states that the first one leads to."""
        seen, waiting = {0}, [0]
        while waiting:
            new = {*self.next[waiting.pop()].values()} - seen
            seen |= new
            waiting += new
        return len(seen)

    def log_likelihood(self, s: str) -> float:
        at, total = 0, 0.0
        for c in s:
            n = self._total(at)
            seen = self.count[at].get(c, 0)
            total += math.log(max(seen / n if n else 0.0, _FLOOR))
            at = self.next[at].get(c, at)
        n = self._total(at)
        return total + math.log(max(self.ends[at] / n if n else 0.0, _FLOOR))


@dataclass
class Formats:
    """Credential automata by kind, that of ordinary tokens, and the score from which a token counts."""

    kinds: dict[str, Automaton]
    ordinary: Automaton
    threshold: float
    shortest: int = SHORTEST

    def __post_init__(self) -> None:
        self.cache: dict[str, float] = {}

    def score(self, token: str) -> float:
        """Nats a character by which the likeliest credential format beats the ordinary one."""
        s = token.translate(_TO_CLASS)
        value = self.cache.get(s)
        if value is None:
            value = max((a.log_likelihood(s) for a in self.kinds.values()), default=-math.inf)
            value = (value - self.ordinary.log_likelihood(s)) / (len(s) + 1)
            if len(self.cache) > 100_000:
                self.cache.clear()
            self.cache[s] = value
        return value

    def spans(self, text: str) -> list[Span]:
        """Pattern matches and inferred credentials, by start and then kind."""
        base = base_spans(text)
        if not self.kinds:
            return base
        more = [("inferred", a, b) for a, b in candidates(text, base, self.shortest) if self.score(text[a:b]) >= self.threshold]
        return sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0])))


def training_examples(docs: DataFrame, text: str = "text", examples: int = EXAMPLES, ordinary: int = ORDINARY) -> list[tuple[str, str]]:
    """(kind, string): the distinct strings of the smallest hashes of each kind, from all texts with a pattern's match.

    Found in the tasks; ids play no part, so rows without one or with the same are learned
    from like others.
    """
    t = F.col("t")
    hit = t.rlike(r"AKIA[A-Z0-9]{16}|[0-9a-f]{24}") | t.rlike(
        r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6}""")

    @F.pandas_udf(T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("s", T.StringType())])))
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[{"kind": k, "s": x} for k, x in sorted(examples_of(v))] for v in texts], dtype=object)

    strings = docs.select(whole_text(text).alias("t")).where(hit).select(F.explode(found("t")).alias("e")).select("e.*").distinct()
    order = Window.partitionBy("kind").orderBy(F.xxhash64("s"), "s")
    # the plain limit is kept in every task ahead of the shuffle
    few = strings.withColumn("place", F.row_number().over(order)).where(F.col("place") <= max(examples, ordinary)).where(
        F.col("place") <= F.when(F.col("kind") == "ordinary", ordinary).otherwise(examples))
    return sorted((r["kind"], r["s"]) for r in few.collect())


def learn(examples: list[tuple[str, str]]) -> Formats:
    """Automata from a bounded list of strings; without a credential among them nothing is inferred."""
    of_kind = lambda kind: [s.translate(_TO_CLASS) for k, s in examples if k == kind]
    kinds = {k: Automaton.learn(of_kind(k), by_depth=True) for k in KINDS if any(k == e[0] for e in examples)}
    shortest = min([SHORTEST, *(len(s) for k, s in examples if k != "ordinary")])
    formats = Formats(kinds, Automaton.learn(of_kind("ordinary")), math.inf, shortest)
    if kinds:
        # tokens of letters and digits may be credentials themselves
        plain = [s for k, s in examples if k == "ordinary" and len(s) >= shortest and not re.search(r"\d.*[A-Za-z]|[A-Za-z].*\d", s)]
        formats.threshold = max([LEAST, *(formats.score(s) + MARGIN for s in plain)])
    return formats


def learn_formats(texts: list[str]) -> Formats:
    """Automata from some texts."""
    return learn(sorted({e for t in texts for e in examples_of(t)}))


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def _with_spans(docs: DataFrame, formats: Formats, result: T.DataType, of) -> Column:
    told = shipped(docs.sparkSession, formats)

    @F.pandas_udf(result)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = told()
        for texts in batches:
            yield pd.Series([of(known, t) for t in texts])
    return run


def scan(docs: DataFrame, formats: Formats, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, spans): the secrets of each row's whole text, one row per row of ``docs``.

    ``spans`` holds kind, start and exclusive end in code points, by start and then kind;
    matches of different kinds may overlap, inferred ones touch no other. Null and empty texts
    have none; ids may be null or repeat; other columns are left out.
    """
    find = _with_spans(docs, formats, SPANS, lambda f, t: [
        {"kind": k, "start": a, "end": b} for k, a, b in f.spans(t)])
    return docs.select(F.col(key).alias("id"), whole_text(text).alias("t")).select("id", find("t").alias("spans"))


def masked(text: str, spans: list[Span], mask: str) -> str:
    out, at = [], 0
    for _, a, b in spans:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mask]
        at = b
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, formats: Formats, text: str = "text", mask: str = "[SECRET]") -> Column:
    """The text with every secret replaced by ``mask``, overlapping ones by one; null stays null."""
    return F.when(F.col(text).isNotNull(), _with_spans(
        docs, formats, T.StringType(), lambda f, t: masked(t, f.spans(t), mask))(whole_text(text)))
