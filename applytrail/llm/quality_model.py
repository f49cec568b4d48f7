"""Quality scores: a document classifier's evidence, and what is known of host and path.

A logistic classifier over the ratios of the quality rules gives each document's own
evidence. The mean probability of a host is shrunk toward that of all documents, and the mean
of a path toward its host's, the more the fewer documents there are; how much follows from
the spread between hosts and between paths (empirical Bayes, beta prior by moments). A
document's final odds are its own, times the odds of its path over those of all documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from applytrail.llm.common import chosen, written
from applytrail.llm.quality_rules import measures

TRAINING_ROWS = 6000  # labelled rows the classifier is fitted on, those of the smallest id hashes
RIDGE = 1.0
FEATURES = ("words", "word_length", "symbols", "stop_words", "capitals", "dup_lines", "repeats")
_EDGE = 1e-6


def ratios(docs: DataFrame, key: str, host: Column, path: Column, text: str = "text") -> DataFrame:
    """(id, host, path) and the classifier's features; null hosts and paths count as empty ones."""
    rows = measures(docs.select(F.col(key).alias("id"), F.coalesce(host.cast("string"), F.lit("")).alias("host"),
                                F.coalesce(path.cast("string"), F.lit("")).alias("path"), F.col(text).alias("text")),
                    keep=("id", "host", "path"))
    share = lambda top, bottom, most: F.least(F.col(top) / F.greatest(F.col(bottom), F.lit(1)), F.lit(most))
    return rows.select(
        "id", "host", "path", F.log1p("n_words").alias("words"), share("word_chars", "n_words", 30.0).alias("word_length"),
        share("n_symbols", "n_words", 2.0).alias("symbols"), share("n_stop_words", "n_words", 1.0).alias("stop_words"),
        share("n_capital_words", "n_words", 1.0).alias("capitals"), share("n_dup_lines", "n_lines", 1.0).alias("dup_lines"),
        share("n_repeat_words", "n_words", 1.0).alias("repeats"))


@dataclass
class Classifier:
    weights: list[float]  # one per feature
    bias: float

    def probability(self) -> Column:
        logit = F.lit(self.bias)
        for name, w in zip(FEATURES, self.weights, strict=True):
            logit = logit + F.col(name) * F.lit(w)
        return 1 / (1 + F.exp(-F.least(F.greatest(logit, F.lit(-12.0)), F.lit(12.0))))


def fit(x: np.ndarray, y: np.ndarray) -> Classifier:
    """Ridge logistic regression by Newton steps; one label alone gives its smoothed share."""
    if not len(y) or y.min() == y.max():
        p = (y.sum() + 1) / (len(y) + 2)
        return Classifier([0.0] * len(FEATURES), float(np.log(p / (1 - p))))
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.concatenate([(x - mean) / spread, np.ones((len(x), 1))], axis=1)
    ridge = np.diag([RIDGE] * len(FEATURES) + [1e-6])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    scaled = w[:-1] / spread
    return Classifier([float(v) for v in scaled], float(w[-1] - (scaled * mean).sum()))


def _pooled(groups: DataFrame, prior: Column) -> float:
    """Strength of the beta prior over groups' means (n, s), from the spread between them.

    Weighted moments of one row: nothing but that row reaches the driver. Equal means give a
    strong prior, one group alone a weak one.
    """
    m = F.col("s") / F.col("n")
    r = groups.agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("s").alias("s"),
                   F.sum(F.col("n") * (m - prior) ** 2).alias("q")).first()
    if not r["n"] or r["k"] < 2:
        return 10.0
    mu = min(max(r["s"] / r["n"], _EDGE), 1 - _EDGE)
    within = mu * (1 - mu)
    between = max((r["q"] - (r["k"] - 1) * within) / r["n"], 0.0)
    return float(min(max(within / between - 1, 1.0), 1000.0)) if between > 0 else 1000.0


def score(docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", host: str | Column = "source",
          path: str | Column = "lang", text: str = "text", label: str = "quality", threshold: float = 0.5) -> DataFrame:
    """(id, document, host_mean, path_mean, score, predicted): one row per row of ``docs``.

    ``learn`` is a condition on the labels' ``key`` column: which labels may be learned from. A document
    labelled twice counts as good if one label says so. A document's own evidence is taken
    out of its host's and path's means. Null texts count as empty, null hosts and paths as
    one of the empty name; ids may be null or repeat; other columns are left out.
    """
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    rows = written(ratios(docs, key, as_column(host), as_column(path), text), "quality-ratios")
    known = chosen(labels.where(F.col(label).isNotNull() & learn).groupBy(F.col(key).alias("id")).agg(
        F.max(label).alias("y")), TRAINING_ROWS)
    # one row an id, the least of those that share it
    labelled = rows.join(F.broadcast(known), "id").groupBy("id", "y").agg(F.min(F.struct(*FEATURES)).alias("of"))
    sample = labelled.select("of.*", "y").orderBy(*FEATURES, "y").collect()
    x = np.array([[r[f] for f in FEATURES] for r in sample], dtype=np.float64).reshape(-1, len(FEATURES))
    model = fit(x, np.array([float(r["y"]) for r in sample]))

    own = rows.select("id", "host", "path", model.probability().alias("document"))
    paths = written(own.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("document").alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    mu = min(max(total["s"] / total["n"], _EDGE), 1 - _EDGE) if total["n"] else 0.5
    host_prior = _pooled(hosts, F.lit(mu))
    around = paths.join(hosts.select("host", F.col("n").alias("host_n"), F.col("s").alias("host_s")), "host")
    path_prior = _pooled(around, F.col("host_s") / F.col("host_n"))

    p = F.col("document")
    joined = own.join(around, ["host", "path"])
    host_mean = (F.col("host_s") - p + host_prior * mu) / (F.col("host_n") - 1 + host_prior)
    with_host = joined.withColumn("host_mean", host_mean)
    path_mean = (F.col("s") - p + path_prior * F.col("host_mean")) / (F.col("n") - 1 + path_prior)
    odds = lambda c: c / (1 - c)
    kept_in = lambda c: F.least(F.greatest(c, F.lit(_EDGE)), F.lit(1 - _EDGE))
    final = odds(kept_in(p)) * odds(kept_in(F.col("path_mean"))) / odds(F.lit(mu))
    scored = with_host.withColumn("path_mean", path_mean).withColumn("score", final / (1 + final))
    return scored.select("id", "document", "host_mean", "path_mean", "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
