"""The corpus pipeline: quality rules, near-duplicates, decontamination, secrets, SentencePiece."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from applytrail.llm import decontamination, pieces, quality_rules, secrets, simhash
from applytrail.llm.common import prepare, table, whole_text, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
MODEL = "piece_bpe_32k.model"

# inferred secret formats, learned features of fingerprints and pieces are beyond SQL
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects.

    Null and empty texts have too few words and go; repeated rows and ties share one verdict;
    null ids, languages and sources pass unread; an empty table gives an empty one.
    """
    prepare(spark)
    return quality_rules.judge(docs, keep=COLUMNS).where("kept").select(*COLUMNS)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group that SimHash links (3 words, 2 bits).

    Null and empty texts are copies of one another. Rows that share an id are one document and
    stay together, unless another of its texts links it to a smaller id; rows without an id
    stay. An empty table gives an empty one.
    """
    prepare(spark)
    linked = simhash.near_duplicates(docs)
    dropped = linked.where("id <> component").select(F.col("id").alias("doc_id")).distinct()
    return docs.select(*COLUMNS).join(dropped, "doc_id", "left_anti").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item.

    Null and empty texts contain none and stay, null ids too; repeated rows share one verdict;
    without items, or of an empty table, all rows stay.
    """
    prepare(spark)
    return decontamination.without_contained(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, secrets masked; ``n_chars`` follows a changed text.

    Null and empty texts, null ids and repeated rows pass as they are; an empty table gives an empty one.
    """
    prepare(spark)
    formats = secrets.learn(secrets.training_examples(docs))
    masked = docs.select("doc_id", F.col("text").alias("before"), secrets.redacted(docs, formats).alias("text"), "lang",
                         "source", "n_chars")
    n_chars = F.when(F.col("text") == F.col("before"), F.col("n_chars")).otherwise(
        F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return masked.select("doc_id", "text", "lang", "source", n_chars.alias("n_chars"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text.

    Null and empty texts have no pieces; repeated rows repeat; an empty table gives an empty one.
    """
    prepare(spark)
    path = public_tokenizers.path(MODEL)
    rows = docs.select("doc_id", "lang", "source", whole_text().alias("t"), pieces.ids_of(docs, path).alias("ids"))
    back = rows.select("*", pieces.text_of(rows, path).alias("decoded"))
    return back.select("doc_id", "lang", "source", "ids", F.size("ids").alias("n_pieces"),
                       (F.col("decoded") == F.col("t")).alias("round_trip"))


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", dedup),
    ("benchmark_decontamination", decontaminate),
    ("secret_scans", mask_secrets),
    ("sentencepiece", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
