"""Toxicity by a subsequence string kernel, Nyström landmarks and a support vector machine.

The kernel of two strings counts the three-letter subsequences they share, gaps allowed, each
discounted by the length it spans; inserted characters and punctuation lower it, they do not
break it. Strings are the words of a sentence, and runs of single letters taken together.

Labels belong to texts, so training is multi-instance: every word of a text labelled clean
is a clean example; of a text labelled toxic those words are toxic examples whose document
counts speak for it, the witnesses. Later rounds add the clean words that the machine of the
round before took for toxic. The machine is linear in Nyström features, which makes it one
weight per subsequence once trained; words are scored in bulk, each once a task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from applytrail.llm.common import chosen, shipped, whole_text, written

TRAINING_ROWS = 6000   # labelled rows a model is fitted on, those of the smallest id hashes
WITNESSES = 400        # toxic words kept
CLEAN_WORDS = 3000     # clean examples added in each round
LANDMARKS = 300        # of the Nyström features, toxic and clean words half and half
ROUNDS = 3
DECAY = 0.7            # discount of each letter that a subsequence spans
SPAN = 5               # letters a subsequence of three may span
LONGEST = 24           # longer strings are scored in overlapping windows
CACHE_SIZE = 200_000   # words a task remembers; a full cache starts anew
THRESHOLD = 0.3        # score from which a text counts as toxic

_SIZE = 32
_EDGE = 31
_CHUNK = 4000  # words scored at a time
_PAIRS = [(j, k) for k in range(2, SPAN) for j in range(1, k)]
_NOISE = re.compile(r"[^\w\s]|[\d_]")
_SPACED = re.compile(r"(?<!\S)(?:\S\s+){2,}\S(?!\S)")


def strings(text: str) -> set[str]:
    """The distinct words of a text, letters alone, and its runs of single letters joined."""
    clean = _NOISE.sub("", text.lower())
    out = set(clean.split())
    for run in _SPACED.findall(clean):
        out.add("".join(run.split()))
    return out


def _coded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters as numbers, a word a row, an edge mark at both ends; and the rows' lengths."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)
    symbol = np.where((points >= 97) & (points <= 122), points - 96, 26 + points % 5)
    grid = np.zeros((len(words), LONGEST + 2 + SPAN), dtype=np.int64)
    row = np.repeat(np.arange(len(words)), lengths)
    column = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    grid[row, column + 1] = symbol
    grid[:, 0] = _EDGE
    grid[np.arange(len(words)), lengths + 1] = _EDGE
    return grid, lengths + 2


def _subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the subsequences of each word and their discounts (0 where there is none)."""
    grid, lengths = _coded(words)
    width = LONGEST + 2
    codes, weights = [], []
    for j, k in _PAIRS:
        codes.append((grid[:, :width] * _SIZE + grid[:, j:j + width]) * _SIZE + grid[:, k:k + width])
        weights.append(np.where(np.arange(width) + k < lengths[:, None], DECAY ** (k + 1), 0.0))
    return np.concatenate(codes, axis=1), np.concatenate(weights, axis=1).astype(np.float32)


def _norms(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Length of each row's feature vector: equal subsequences add up before they are squared."""
    order = np.argsort(codes, axis=1, kind="stable")
    c, w = np.take_along_axis(codes, order, 1), np.take_along_axis(weights, order, 1).astype(np.float64)
    sums = np.cumsum(w, axis=1)
    last = np.concatenate([c[:, 1:] != c[:, :-1], np.ones((len(c), 1), dtype=bool)], axis=1)
    row, _ = np.nonzero(last)
    ends = sums[last]
    before = np.concatenate([[0.0], ends[:-1]])
    before[np.concatenate([[True], row[1:] != row[:-1]])] = 0.0
    return np.sqrt(np.bincount(row, weights=(ends - before) ** 2, minlength=len(c)))


def features(words: list[str]) -> np.ndarray:
    """Unit vectors of the kernel's feature space, one row per word; zero without a subsequence."""
    codes, weights = _subsequences(words)
    out = np.zeros((len(words), _SIZE ** 3), dtype=np.float32)
    np.add.at(out, (np.arange(len(words))[:, None], codes), weights)
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, length, out=out, where=length > 0)


def windows(word: str) -> list[str]:
    if len(word) <= LONGEST:
        return [word]
    step = LONGEST // 2
    return [word[i:i + LONGEST] for i in range(0, len(word) - step, step)]


@dataclass
class Machine:
    """``weight`` per subsequence and a bias; ``doc`` turns a text's word scores into a probability."""

    weight: np.ndarray
    bias: float
    doc: np.ndarray | None = None

    def score_words(self, words: list[str]) -> np.ndarray:
        """Decision values, never under the bias: the largest over a long word's windows."""
        parts = [windows(w) for w in words]
        flat = [p for ps in parts for p in ps]
        values = np.full(len(flat), self.bias)
        for start in range(0, len(flat), _CHUNK):
            codes, weights = _subsequences(flat[start:start + _CHUNK])
            dots = np.einsum("ij,ij->i", self.weight[codes], weights)
            some = np.flatnonzero(dots > 0)
            if len(some):
                values[start + some] += dots[some] / np.maximum(_norms(codes[some], weights[some]), 1e-9)
        first = np.cumsum([0] + [len(p) for p in parts])[:-1]
        return np.maximum.reduceat(values, first) if len(flat) else values

    def summary(self, scores: list[float]) -> tuple[float, float, float]:
        """What a text is judged by: its best word, the sum of its toxic words' margins, their share."""
        top = max(scores, default=self.bias)
        hits = [s for s in scores if s > 0]
        return max(top, -1.0), min(sum(hits), 10.0), 100.0 * len(hits) / (len(scores) + 10)

    def probability(self, summaries: np.ndarray) -> np.ndarray:
        if self.doc is None:
            return np.zeros(len(summaries))
        x = np.concatenate([summaries, np.ones((len(summaries), 1))], axis=1)
        return 1 / (1 + np.exp(-np.clip(x @ self.doc, -30, 30)))


def support_vectors(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps over the examples inside the margin."""
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(rounds):
        inside = y * (x @ w) < 1
        a = x[inside] * cost[inside, None]
        new = np.linalg.solve(ridge + a.T @ x[inside], a.T @ y[inside])
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w


def _fit(toxic: list[tuple[str, float]], clean: list[tuple[str, float]]) -> Machine:
    half = LANDMARKS // 2
    marks = features([w for w, _ in toxic[:half]] + [w for w, _ in clean[-half:]])
    kernel = marks @ marks.T
    values, vectors = np.linalg.eigh(kernel.astype(np.float64))
    good = values > 1e-4
    root = vectors[:, good] / np.sqrt(values[good])  # Nyström map: kernel values with the landmarks times this
    examples = toxic + clean
    mapped = np.concatenate([features([w for w, _ in examples[i:i + 250]]) @ marks.T
                             for i in range(0, len(examples), 250)]) @ root
    x = np.concatenate([mapped, np.ones((len(mapped), 1))], axis=1)
    y = np.repeat([1.0, -1.0], [len(toxic), len(clean)])
    share = np.array([n for _, n in examples])
    balance = np.where(y > 0, 200.0 / max(share[y > 0].sum(), 1e-9) * 1.0, 400.0 / max(share[y < 0].sum(), 1e-9))
    w = support_vectors(x, y, share * balance)
    return Machine((marks.T @ (root @ w[:-1])).astype(np.float32), float(min(w[-1], -1e-3)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def training_rows(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = TRAINING_ROWS) -> DataFrame:
    """(id, t, label): the texts of the ``rows`` labelled ids with the smallest hashes, one an id.

    Of texts that share an id the one of the smallest hash is taken. The ids, ``rows`` at most,
    are broadcast, and their texts are reduced before they are shuffled.
    """
    known = labels.where(F.col("toxic").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max("toxic").alias("label"))
    ids = chosen(known.withColumn("doc_id", F.col("id")).where(learn), rows).select("id", "label")
    texts = docs.select(F.col("doc_id").alias("id"), whole_text().alias("t")).join(F.broadcast(ids), "id")
    return texts.groupBy("id", "label").agg(F.min_by("t", F.struct(F.xxhash64("t"), "t")).alias("t")).select("id", "t", "label")


def train(rows: DataFrame) -> Machine | None:
    """A machine from (id, t, label) rows; None if either label is missing among them."""
    rows = written(rows, "toxicity-rows")
    split = F.udf(lambda t: sorted({p for w in strings(t) for p in windows(w)}), "array<string>")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return None
    words = written(rows.select("label", F.explode(split("t")).alias("word")).groupBy("word").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")), "toxicity-words")
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    # a witness is well above chance even when two texts less had held it
    sure = F.log(F.greatest(F.col("toxic") - 2, F.lit(0)) + 0.1) - F.log((F.col("clean") + 0.5) * n_toxic / n_clean)
    witnesses = words.where((F.col("toxic") >= 3) & (F.length("word") >= 3) & (odds > 2.0) & (sure > 0.5))
    toxic = [(r["word"], float(r["toxic"])) for r in
             witnesses.orderBy((-odds * F.col("toxic")), "word").limit(WITNESSES).collect()]
    if not toxic:
        return None
    taken = {w for w, _ in toxic}
    benign = words.where((F.col("clean") > 0) & (F.length("word") >= 3))
    clean = [(r["word"], 1.0) for r in benign.orderBy(F.desc("clean"), "word").limit(CLEAN_WORDS).collect()
             if r["word"] not in taken]
    clean.reverse()
    machine = _fit(toxic, clean)
    for _ in range(ROUNDS):
        score = scorer(machine)
        hard = [r["word"] for r in benign.select("word", score("word").alias("s")).where("s > -0.7").orderBy(
            F.desc("s"), "word").limit(CLEAN_WORDS).collect()]
        known = {w for w, _ in clean} | taken
        new = [(w, 1.0) for w in hard if w not in known]
        if not new:
            break
        clean += reversed(new)  # the landmarks take the hardest, at the end
        machine = _fit(toxic, clean)
    judged = rows.select(F.col("label"), summarised(rows.sparkSession, machine)("t").alias("s")).collect()
    x, y = np.array([r["s"] for r in judged]), np.array([float(r["label"]) for r in judged])
    order = np.lexsort((y, *x.T))
    machine.doc = _logistic(x[order], y[order])
    return machine


def scorer(machine: Machine):
    """A column function from words to decision values."""
    @F.pandas_udf("double")
    def score(words: pd.Series) -> pd.Series:
        return pd.Series(machine.score_words(words.tolist()))
    return score


def summarised(spark, machine: Machine):
    """A column function from texts to their summaries."""
    told = shipped(spark, machine)

    @F.pandas_udf("array<double>")
    def summary(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = told()
        cache: dict[str, float] = {}
        for texts in batches:
            split = [strings(t) for t in texts]
            new = list(set().union(*split).difference(cache))
            scores = dict(zip(new, known.score_words(new).tolist(), strict=True))
            if len(cache) + len(new) > CACHE_SIZE:
                old = {w: s for ws in split for w in ws if (s := cache.get(w)) is not None}
                cache = old
            cache.update(scores)
            yield pd.Series([list(known.summary([cache[w] for w in ws])) for ws in split])
    return summary


def score(docs: DataFrame, machine: Machine | None, key: str = "doc_id", text: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """(id, score, predicted): one row per row of ``docs``, other columns left out.

    Null and empty texts are scored as texts without words. Without a machine (no labelled
    rows of both kinds) every score is 0. Ids may be null or repeat.
    """
    rows = docs.select(F.col(key).alias("id"), whole_text(text).alias("t"))
    if machine is None:
        scored = rows.select("id", F.lit(0.0).alias("score"))
    else:
        a, b, c, d = (float(v) for v in machine.doc)
        s = F.col("s")
        logit = s[0] * a + s[1] * b + s[2] * c + d
        scored = rows.select("id", summarised(docs.sparkSession, machine)("t").alias("s")).select(
            "id", (1 / (1 + F.exp(-F.least(F.greatest(logit, F.lit(-30.0)), F.lit(30.0))))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
