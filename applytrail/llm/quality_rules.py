"""Quality rules: a table of thresholds, compiled into DataFrame expressions.

No user function, no shuffle: every ratio comes from arrays inside the row.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from applytrail.llm.common import SPACE, whole_text

SYMBOLS = "#*$%&|<>"

STOP_WORDS = {
    "en": ("the", "be", "to", "of", "and", "that", "have", "with", "is", "in", "a", "it", "for", "was", "on", "are"),
    "fr": ("le", "la", "les", "de", "des", "du", "et", "un", "une", "que", "qui", "en", "dans", "pour", "par", "sur"),
    "de": ("der", "die", "das", "und", "ein", "eine", "zu", "von", "mit", "den", "dem", "auf", "für", "ist", "nicht"),
    "es": ("el", "la", "los", "las", "de", "y", "que", "en", "un", "una", "por", "con", "para", "del", "se", "al"),
}


@dataclass(frozen=True)
class Rule:
    """``top / bottom`` must lie within [low, high]; a document without ``bottom`` has ratio 0."""

    name: str
    top: str
    bottom: str
    low: float | None = None
    high: float | None = None

    def fails(self) -> Column:
        top, bottom = F.col(self.top), F.col(self.bottom)
        ratio = F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))
        bounds = []
        if self.low is not None:
            bounds.append(ratio < self.low)
        if self.high is not None:
            bounds.append(ratio > self.high)
        return reduce(operator.or_, bounds)


RULES = (
    Rule("word_length", "word_chars", "n_words", low=2.0, high=15.0),
    Rule("symbols", "n_symbols", "n_words", high=0.3),
    Rule("stop_words", "n_stop_words", "n_words", low=0.01),
    Rule("capitals", "n_capital_words", "n_words", high=0.6),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.6),
)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_capital_words",
            "n_lines")


def _position_array(count: Column) -> Column:
    """0 .. count - 1; empty for count 0 or less."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def _repeated_places() -> Column:
    """Places of windows whose hash occurs again, from hashes ``h`` and the repeated ones ``d``.

    Few repeated hashes are looked up one by one; many by sorting hashes with their places.
    Both ways give the same places, in ascending order.
    """
    places = F.sequence(F.lit(0), F.size("h") - 1)
    looked_up = F.filter(places, lambda i: F.array_contains("d", F.get("h", i)))
    return F.when(F.size("d") == 0, F.array().cast("array<int>")).when(F.size("d") <= 32, looked_up).otherwise(
        F.sort_array(F.filter(F.transform(
            F.sequence(F.lit(0), F.size("o") - 1),
            lambda j: F.when((F.get("o", j)["h"] == F.get("o", j + 1)["h"]) | (F.get("o", j)["h"] == F.get("o", j - 1)["h"]),
                             F.get("o", j)["i"])), lambda i: i.isNotNull())))


def measures(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns and the counts named in ``MEASURES``, one row per input row.

    A null text has no words. Windows of three words are compared by their 64-bit hashes.
    """
    stop = sorted({w for words in STOP_WORDS.values() for w in words})
    kept = [F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]
    held = [F.col(f"_k{i}") for i in range(len(keep))]

    split = docs.select(*kept, whole_text(text).alias("t")).select(
        *held,
        F.array_remove(F.split("t", SPACE), "").alias("w"),
        F.filter(F.split("t", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        (F.length("t") - F.length(reduce(lambda c, s: F.replace(c, F.lit(s), F.lit("")), SYMBOLS, F.col("t"))))
        .alias("n_symbols"),
    )
    counted = split.select(
        *held, "n_symbols",
        F.size("w").alias("n_words"),
        F.length(F.array_join("w", "")).alias("word_chars"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size(F.filter("w", lambda x: F.lower(x).isin(*stop))).alias("n_stop_words"),
        F.size(F.filter("w", lambda x: (x == F.upper(x)) & (x != F.lower(x)))).alias("n_capital_words"),
        F.transform(_position_array(F.size("w") - 2),
                    lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2))).alias("h"),
    )
    numbers = [F.col(m) for m in MEASURES if m != "n_repeat_words"]
    in_order = counted.select(*held, *numbers, "h", F.sort_array("h").alias("s"))
    repeated = in_order.select(
        *held, *numbers, "h",
        F.array_distinct(F.filter("s", lambda x, j: x == F.get("s", j + 1))).alias("d"),
    )
    with_places = repeated.select(
        *held, *numbers, "h", "d",
        F.when(F.size("d") > 32, F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
        .alias("o"),
    )
    covered = F.aggregate(
        _repeated_places(), F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")),
        lambda acc: acc["n"])
    rows = with_places.select(*held, *numbers, F.coalesce(covered, F.lit(0)).alias("n_repeat_words"))
    # a generator of one row: filters on the counts stay above it and don't repeat the array work
    counts = F.struct(*[F.col(m).cast("long").alias(m) for m in MEASURES])
    return rows.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], F.inline(F.array(counts)))


def base_failed() -> Column:
    """Fewer than 50 words, or over half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def failed_rules(rules: Sequence[Rule] = RULES) -> Column:
    """Names of the rules that a row of ``measures`` breaks."""
    return F.filter(F.array(*[F.when(r.fails(), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, keep: Sequence[str] = ("doc_id",), text: str = "text",
          base: Callable[[], Column] = base_failed) -> DataFrame:
    """Measures, ``base_failed``, the rules each row breaks, and ``kept``.

    One row per input row, repeated ids included; other columns of ``docs`` are left out,
    whatever their names. Null and empty texts have no words and fail the base rule.
    """
    rows = measures(docs, keep, text)
    broken = failed_rules(rules)
    return rows.select(*keep, *MEASURES, base().alias("base_failed"), broken.alias("failed_rules"),
                       (~base() & (F.size(broken) == 0)).alias("kept"))
