"""Line dedup: levelled, sorted runs of line hashes that batches of documents are held against."""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from applytrail.llm.common import whole_text, written
from applytrail.sources.scratch import shared_folder

MIN_CHARS = 40    # code points of a key that may be dropped
MIN_DOCS = 5      # documents that make a line common
BATCHES = 4       # parts of the input that are added one after another
FANOUT = 2        # runs of a level that are merged into one of the next
HOT_SHARE = 1000  # a key in more than 1 of so many documents is looked up in a broadcast table

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

DROPPED = T.StructType([T.StructField("n_dropped", T.LongType()), T.StructField("kept", T.StringType())])


def line_keys(text: str, least: int = MIN_CHARS) -> list[bytes | None]:
    """One digest per line of its stripped, lower-cased form; None where that is shorter than ``least``."""
    keys: list[bytes | None] = []
    for line in text.encode().translate(_LOWER).split(b"\n"):
        key = line.strip()
        long = len(key) >= least and (key.isascii() or len(key.decode()) >= least)
        keys.append(xxhash.xxh3_128_digest(key) if long else None)
    return keys


def without(text: str, keys: set[bytes], least: int = MIN_CHARS) -> tuple[int, str]:
    """The text without the lines that have one of the keys, and their number."""
    lines = text.split("\n")
    kept = [line for line, key in zip(lines, line_keys(text, least), strict=True) if key not in keys]
    return len(lines) - len(kept), "\n".join(kept)


def keyed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """(id, mark, key, batch): one row per row of ``docs`` and different line key in it."""
    @F.arrow_udf(T.ArrayType(T.BinaryType()))
    def keys_of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in columns:
            yield pa.array([sorted({k for k in line_keys(t, least) if k}) for t in texts.to_pylist()], pa.list_(pa.binary()))

    rows = docs.select(F.col(key).alias("id"), whole_text(text).alias("t")).select("id", F.xxhash64("t").alias("mark"), "t")
    batch = F.pmod(F.xxhash64("id", "mark"), F.lit(batches)).cast("int").alias("batch")
    return rows.select("id", "mark", batch, keys_of("t").alias("keys")).select("id", "mark", "batch", F.explode("keys").alias("key"))


class LineRuns:
    """A growing index of line keys: (key, n, last) with the documents seen and the largest id of them.

    Every run is a table bucketed and sorted by key, one file a bucket, so that runs meet each
    other and a batch without being shuffled again. ``add`` holds a batch against every run
    and writes what the runs lack as a run of level 0; ``FANOUT`` runs of a level are
    merged into one of the next. A written run is never changed: a lost executor costs the
    tasks it ran, and a failed job leaves the levels as they were.
    """

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self.tables: list[str] = []
        # a bucket of one sorted file counts as sorted
        spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")

    def _run(self, entries: DataFrame) -> DataFrame:
        name = f"line_run_{uuid4().hex}"
        entries.write.bucketBy(self.buckets, "key").sortBy("key").option(
            "path", f"{shared_folder(self.spark)}/{name}").saveAsTable(name)
        self.tables.append(name)
        return self.spark.table(name)

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        """One sorted sequence of several: keys in two runs add up."""
        whole = runs[0]
        for run in runs[1:]:
            n = F.coalesce(whole["n"], F.lit(0)) + F.coalesce(run["n"], F.lit(0))
            whole = whole.join(run, whole["key"] == run["key"], "full").select(
                F.coalesce(whole["key"], run["key"]).alias("key"), n.alias("n"), F.greatest(whole["last"], run["last"]).alias("last"))
        return whole

    def add(self, lines: DataFrame) -> None:
        """Add a batch of (id, key), one row per document and key of it.

        A key that one run already has in ``min_docs`` documents, the largest of them beyond
        all of the batch, tells nothing new: the merge-anti-join leaves it out.
        """
        new = lines.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("last"))
        for run in (r for level in self.levels for r in level):
            known = run.where(F.col("n") >= self.min_docs)
            new = new.join(known, (new["key"] == known["key"]) & (known["last"] >= new["last"]), "left_anti")
        carried, level = self._run(new), 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(carried)
            if len(self.levels[level]) < self.fanout:
                return
            carried = self._run(self._merged(self.levels[level]))
            self.levels[level] = []
            level += 1

    def common(self) -> DataFrame:
        """(key, n, last) of the keys in ``min_docs`` documents and more; ``n`` counts at least one batch's."""
        runs = [r for level in self.levels for r in level]
        return self._merged(runs).where(F.col("n") >= self.min_docs)

    def close(self) -> None:
        """Take the runs out of the catalog; their files stay until the folder's retention removes them."""
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _lost(lines: DataFrame, common: DataFrame, documents: int, share: int) -> DataFrame:
    """(id, mark, key) of the lines that go: all of a common key but those of the largest id.

    Keys of a large share of the documents are few, at most ``share`` times the mean number of
    keys in a document, and broadcast: none of the rows shuffled for the others is of a hot key.
    """
    lost = F.col("last").isNotNull() & (F.col("id").isNull() | (F.col("id") < F.col("last")))
    hot = F.broadcast(common.where(F.col("n") * share > documents))
    cold = common.where(F.col("n") * share <= documents)
    rows = lines.join(hot, "key").unionByName(lines.join(hot.select("key"), "key", "left_anti").join(cold, "key"))
    return rows.where(lost).select("id", "mark", "key")


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                batches: int = BATCHES) -> DataFrame:
    """(id, n_lines, n_dropped, kept): one row per row of ``docs``, ``kept`` being the text that stays.

    A line of at least ``least`` code points (stripped, A-Z lower-cased) that ``min_docs``
    documents hold stays only in the document of the largest id, in each of its places. Null
    and empty texts are one empty line and stay. Each row counts as a document; rows that
    share the largest id all keep the line. Rows without an id count too, but lose a common line to any
    row with an id; a line of such rows alone stays. Other columns of ``docs`` play no part.
    """
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/lines-{uuid4().hex}"
    keyed = keyed_lines(docs, key, text, least, batches)
    keyed.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(keyed.schema).parquet(path)

    runs = LineRuns(spark, min_docs)
    for batch in range(batches):
        runs.add(lines.where(F.col("batch") == batch))
    common = written(runs.common(), "common")
    runs.close()
    gone = written(_lost(lines, common, docs.count(), HOT_SHARE * batches), "lost").groupBy(
        F.col("id").alias("of"), F.col("mark").alias("of_mark")).agg(F.collect_set("key").alias("gone"))

    @F.pandas_udf(DROPPED)
    def drop(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, keys in batches:
            yield pd.DataFrame([(0, None) if t is None else without(t, set(k), least) for t, k in zip(texts, keys, strict=True)],
                               columns=["n_dropped", "kept"])

    rows = docs.select(F.col(key).alias("id"), whole_text(text).alias("t")).withColumn("mark", F.xxhash64("t"))
    met = rows.join(gone, F.col("id").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("of_mark")), "left")
    # only texts that lose a line go to Python
    touched = F.when(F.col("gone").isNotNull(), F.col("t"))
    return met.select("id", "t", drop(touched, "gone").alias("d")).select(
        "id", F.size(F.split("t", "\n", -1)).cast("long").alias("n_lines"), F.col("d.n_dropped").alias("n_dropped"),
        F.coalesce("d.kept", "t").alias("kept"))
