"""The application store: a bucketed base, batches beside it, and a manifest that names both.

A manifest file lists the folders that are the store as of a batch. Data is written first, into
a folder of its own, then the manifest, by rename: a run that dies between leaves the state
before it, and a replayed batch publishes a newer manifest of its number. Folders that a
reader may be on are never written again. The base is bucketed and sorted by id, so a read
shuffles the batches only; all batches are one scan.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from applytrail.operators.resolve import RECORD_TYPE, keep_created
from applytrail.operators.rows import last_per_key, union_sources

FOLD_BATCHES = 8    # batches from which an upsert folds them into a new base
FOLD_SHARE = 0.25   # rows of all batches over those of the base from which it does
PREFIX = "manifest-"
NUMBER = "_number"


@dataclass
class Folder:
    name: str
    rows: int
    schema: str    # JSON text
    buckets: int = 0


@dataclass
class Manifest:
    """The live folders as of batch ``number``."""

    number: int
    base: Folder | None = None
    batches: list[Folder] = field(default_factory=list)

    def text(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def parsed(text: str) -> "Manifest":
        raw = json.loads(text)
        return Manifest(raw["number"], raw["base"] and Folder(**raw["base"]), [Folder(**b) for b in raw["batches"]])

    def wants_fold(self) -> bool:
        rows = sum(b.rows for b in self.batches)
        return len(self.batches) >= FOLD_BATCHES or bool(self.base and self.base.rows and rows > FOLD_SHARE * self.base.rows)


def _files(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root, root.getFileSystem(spark._jsc.hadoopConfiguration())


def _manifests(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(batch number, attempt) of the published manifests, oldest first."""
    root, fs = _files(spark, path)
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return sorted(tuple(map(int, n.removeprefix(PREFIX).split("-"))) for n in names if n.startswith(PREFIX))


def _manifest(spark: SparkSession, path: str, before: int | None = None) -> Manifest | None:
    """The newest manifest, optionally of a batch before ``before``."""
    found = [m for m in _manifests(spark, path) if before is None or m[0] < before]
    if not found:
        return None
    root, fs = _files(spark, path)
    stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(root, f"{PREFIX}{found[-1][0]}-{found[-1][1]}"))
    try:
        return Manifest.parsed(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _publish(spark: SparkSession, path: str, manifest: Manifest) -> None:
    root, fs = _files(spark, path)
    attempt = max((a for n, a in _manifests(spark, path) if n == manifest.number), default=-1) + 1
    hidden = spark._jvm.org.apache.hadoop.fs.Path(root, f"_{uuid4().hex}")
    stream = fs.create(hidden)
    stream.write(bytearray(manifest.text().encode()))
    stream.close()
    if not fs.rename(hidden, spark._jvm.org.apache.hadoop.fs.Path(root, f"{PREFIX}{manifest.number}-{attempt}")):
        raise OSError(f"another writer published batch {manifest.number} of {path}")


def _table(folder: Folder) -> str:
    return "store_" + folder.name.replace("-", "_")


def _write_base(spark: SparkSession, path: str, df: DataFrame, number: int) -> Folder:
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = Folder(f"base-{number}-{uuid4().hex}", 0, df.schema.json(), buckets)
    df.repartition(buckets, "id").write.bucketBy(buckets, "id").sortBy("id").option(
        "path", f"{path}/{folder.name}").saveAsTable(_table(folder))
    folder.rows = spark.read.schema(df.schema).parquet(f"{path}/{folder.name}").count()
    return folder


def _write_batch(spark: SparkSession, path: str, df: DataFrame, number: int) -> Folder:
    rows = df.withColumn(NUMBER, F.lit(number))
    folder = Folder(f"batch-{number}-{uuid4().hex}", 0, rows.schema.json())
    rows.write.parquet(f"{path}/{folder.name}")
    folder.rows = spark.read.schema(rows.schema).parquet(f"{path}/{folder.name}").count()
    return folder


def _schema(folder: Folder) -> T.StructType:
    return T.StructType.fromJson(json.loads(folder.schema))


def _read_base(spark: SparkSession, path: str, folder: Folder) -> DataFrame:
    name = _table(folder)
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({_schema(folder).toDDL()}) USING parquet CLUSTERED BY (id) SORTED BY (id) "
                  f"INTO {folder.buckets} BUCKETS LOCATION '{path}/{folder.name}'")
    return spark.table(name)


def _read_batches(spark: SparkSession, path: str, folders: list[Folder]) -> DataFrame:
    """All batches in one scan, under all their columns."""
    fields = {f.name: f for folder in folders for f in _schema(folder).fields}
    return spark.read.schema(T.StructType(list(fields.values()))).parquet(*[f"{path}/{f.name}" for f in folders])


def _records(df: DataFrame) -> DataFrame:
    return df.filter(F.col("type") == RECORD_TYPE)


def _read(spark: SparkSession, path: str, manifest: Manifest) -> DataFrame:
    base = _records(_read_base(spark, path, manifest.base)) if manifest.base else None
    if not manifest.batches:
        return base
    newest = last_per_key(_records(_read_batches(spark, path, manifest.batches)), "id", (NUMBER,)).drop(NUMBER)
    if base is None:
        return newest
    return union_sources(base.join(newest.select("id"), "id", "left_anti"), newest)


def next_number(spark: SparkSession, path: str) -> int:
    return max((n for n, _ in _manifests(spark, path)), default=-1) + 1


def read_store(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """Stored application records, the newest of each id, optionally as of an earlier batch.

    Base records only pass an anti join on the ids of the batches; just the batches,
    small next to the base, are ranked and shuffled.
    """
    manifest = _manifest(spark, path, before)
    if manifest is None:
        raise FileNotFoundError(f"no store at {path}")
    return _read(spark, path, manifest)


def init_store(spark: SparkSession, path: str, like: DataFrame) -> None:
    """An empty store with the columns of ``like``, unless there is one already."""
    if _manifest(spark, path) is None:
        empty = spark.createDataFrame([], like.schema)
        _publish(spark, path, Manifest(0, _write_base(spark, path, empty, 0)))


def write_upsert(spark: SparkSession, path: str, updates: DataFrame, number: int | None = None) -> int:
    """Upsert records as one batch and return its number; many or large batches are folded into a new base.

    Writing the same number again replaces that batch, so a replayed stream batch
    leaves the store as it was.
    """
    number = next_number(spark, path) if number is None else number
    state = _manifest(spark, path, number)
    if state is not None:
        updates = keep_created(_read(spark, path, state), updates)
    batch = _write_batch(spark, path, updates, number)
    now = Manifest(number, state and state.base, [*(state.batches if state else []), batch])
    _publish(spark, path, now)
    if now.wants_fold():
        _publish(spark, path, Manifest(number, _write_base(spark, path, _read(spark, path, now), number)))
    return number


def compact(spark: SparkSession, path: str) -> int:
    """Fold all batches into a new base; older folders stay for readers still on them."""
    number = next_number(spark, path)
    _publish(spark, path, Manifest(number, _write_base(spark, path, read_store(spark, path), number)))
    return number
