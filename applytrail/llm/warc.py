"""WARC archives with a two-level capture index.

Every page becomes a gzip member of a WARC file; pages whose payload another page already has
become revisit records. The index holds a line per capture, sorted by a key that starts with
the reversed host name, in compressed blocks; a sparse directory holds each block's first
key. A lookup searches the directories' bounds, then a directory, then a block, each by
bisection, and reads one block and one record by their byte ranges.

Files go to a folder every executor reaches. A task writes files under names of its own and
only names them in its result rows, so a lost or repeated attempt leaves no trace in the index.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from applytrail.llm.common import shipped, written
from applytrail.sources.scratch import shared_folder

LEAST_LOOKUPS, MOST_LOOKUPS = 1000, 100_000  # records read by a task; the number of rows and cores decides between
BLOCK_LINES = 1000       # index lines in a compressed block
FILE_BYTES = 1 << 30     # a WARC file is closed beyond this size
DATE = "2024-01-31T00:00:00Z"  # of the records: pages carry no time of capture
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: Column) -> Column:
    """``com,example,www:80)/path?query``: host names reversed, scheme, user and fragment left out."""
    rest = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"#.*$", "")
    rest = F.regexp_replace(rest, r"^[^/?@]*@", "")
    host = F.lower(F.regexp_extract(rest, r"^([^/?:]*)", 1))
    port = F.regexp_extract(rest, r"^[^/?:]*(:[0-9]+)", 1)
    path = F.regexp_extract(rest, r"^[^/?]*(?s)(.*)$", 1)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), port, F.lit(")"), path)
    return F.coalesce(F.regexp_replace(key, r"[\x00-\x20]", "%20"), F.lit(""))


def capture_key(url: Column, page_id: Column) -> Column:
    return F.concat(url_key(url), F.lit(" "), F.coalesce(page_id.cast("string"), F.lit("")))


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: str, url: str | None, payload: bytes, size: int, sha1: str, refers_to: str | None) -> bytes:
    """One WARC record; a revisit has the header of the HTTP message and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:x-page:{page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{sha1}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:x-page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode("utf-8", "replace") + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """What a record says; the payload's digest and size are computed where it is there."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    said = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    revisit = fields["WARC-Type"] == "revisit"
    page = lambda name: fields[name][len("<urn:x-page:"):-1] or None
    return {"page_id": page("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"),
            "payload_bytes": said if revisit else len(payload),
            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else digest(payload),
            "record_type": fields["WARC-Type"], "refers_to": page("WARC-Refers-To") if revisit else None,
            "payload": None if revisit else payload}


class _Writer:
    """Appends gzip members to files of one folder and tells where they went."""

    def __init__(self, folder: str, prefix: str, suffix: str) -> None:
        self.files, self.root = fs.FileSystem.from_uri(folder)
        self.prefix, self.suffix, self.out, self.name, self.at = prefix, suffix, None, "", 0

    def add(self, data: bytes) -> tuple[str, int, int]:
        if self.out is None or self.at >= FILE_BYTES:
            self.close()
            self.files.create_dir(self.root)
            self.name = f"{self.prefix}-{uuid4().hex}{self.suffix}"
            self.out, self.at = self.files.open_output_stream(f"{self.root}/{self.name}", compression=None), 0
        member = gzip.compress(data, 6, mtime=0)
        self.out.write(member)
        self.at += len(member)
        return self.name, self.at - len(member), len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


class _Reader:
    """Reads byte ranges of a folder's files; a few files stay open."""

    def __init__(self, folder: str) -> None:
        self.files, self.root = fs.FileSystem.from_uri(folder)
        self.open: OrderedDict[str, object] = OrderedDict()

    def member(self, name: str, offset: int, length: int) -> bytes:
        if name not in self.open:
            if len(self.open) >= 32:
                self.open.popitem(last=False)[1].close()
            self.open[name] = self.files.open_input_file(f"{self.root}/{name}")
        self.open.move_to_end(name)
        return gzip.decompress(self.open[name].read_at(length, offset))


@dataclass
class Archive:
    """Where the files are, and the bounds of the index's shards: one entry per written shard."""

    folder: str
    shards: list[tuple[str, str, int, int]]  # first key; file, offset and length of the shard's directory


def captures(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """(page_id, url, payload, size, sha1, refers_to): which pages repeat which.

    Of pages with equal payloads of at least ``least`` bytes that with the smallest id is kept
    whole, the others refer to it (null ids too); rows that share that smallest id are all
    kept whole. Payloads are compared by SHA-1 and size. A null html has an empty payload.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"),
                        F.octet_length(payload).cast("long").alias("size"), F.sha1(payload).alias("sha1"))
    # written, so that the planner knows their size: payloads are not shuffled where few repeat
    firsts = written(rows.where(F.col("size") >= least).groupBy("sha1", "size").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "repeated-payloads")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(firsts, ["sha1", "size"], "left").select(
        "page_id", "url", F.when(refers_to.isNull(), F.col("payload")).alias("payload"), "size", "sha1",
        refers_to.alias("refers_to"))


def archive(rows: DataFrame) -> Archive:
    """Write ``captures`` rows as WARC files, then the index over them."""
    folder = f"{shared_folder(rows.sparkSession)}/warc-{uuid4().hex}"

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = _Writer(folder, "pages", ".warc.gz")
        for batch in batches:
            lines = []
            for r in batch.itertuples(index=False):
                data = record(r.page_id or "", r.url, (r.payload or "").encode("utf-8", "replace"), r.size,
                              base64.b32encode(bytes.fromhex(r.sha1)).decode(), r.refers_to)
                lines.append((r.key, *out.add(data)))
            yield pd.DataFrame(lines, columns=["key", "file", "start", "length"])
        out.close()

    plain = rows.select(capture_key(F.col("url"), F.col("page_id")).alias("key"), F.col("page_id").cast("string").alias("page_id"),
                        "url", "payload", "size", "sha1", F.col("refers_to").cast("string").alias("refers_to"))
    lines = written(plain.mapInPandas(write, "key string, file string, start long, length long"), "captures")

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, waiting, directory = _Writer(folder, "index", ".cdx.gz"), [], []

        def flush(part: list) -> None:
            text = "\n".join(json.dumps(line) for line in part)
            directory.append((part[0][0], *out.add(text.encode("utf-8", "replace"))))

        for batch in batches:
            waiting += [(k, f, int(s), int(n)) for k, f, s, n in batch.itertuples(index=False, name=None)]
            while len(waiting) >= BLOCK_LINES:
                flush(waiting[:BLOCK_LINES])
                del waiting[:BLOCK_LINES]
        if waiting:
            flush(waiting)
        if directory:
            place = out.add("\n".join(json.dumps(entry) for entry in directory).encode("utf-8", "replace"))
            out.close()
            yield pd.DataFrame([(directory[0][0], *place)], columns=["first", "file", "start", "length"])

    # the range exchange deals out captures, not URLs: a URL of many captures is spread
    ordered = lines.repartitionByRange("key", "file", "start").sortWithinPartitions("key", "file", "start")
    shards = written(ordered.mapInPandas(index, "first string, file string, start long, length long"), "shards")
    return Archive(folder, sorted(tuple(r) for r in shards.collect()))  # a row per shard, not per page or block


class Lookup:
    """Finds captures by key. ``directory`` and block of the last key stay loaded."""

    def __init__(self, where: Archive) -> None:
        self.reader, self.shards = _Reader(where.folder), where.shards
        self.bounds = [s[0] for s in where.shards]
        self.directories: OrderedDict[int, tuple[list, list]] = OrderedDict()
        self.block: tuple[object, list, list] = (None, [], [])

    def _directory(self, shard: int) -> tuple[list, list]:
        """A shard's blocks and their first keys."""
        if shard not in self.directories:
            if len(self.directories) >= 4:
                self.directories.popitem(last=False)
            text = self.reader.member(*self.shards[shard][1:]).decode("utf-8")
            blocks = [json.loads(line) for line in text.split("\n")]
            self.directories[shard] = blocks, [b[0] for b in blocks]
        return self.directories[shard]

    def _lines(self, place: list) -> tuple[list, list]:
        """A block's captures and their keys."""
        if self.block[0] != tuple(place):
            text = self.reader.member(*place).decode("utf-8")
            lines = [json.loads(line) for line in text.split("\n")]
            self.block = tuple(place), lines, [line[0] for line in lines]
        return self.block[1:]

    def find(self, key: str) -> Iterator[dict]:
        """Records of every capture under the key, which may run over blocks and shards."""
        shard = max(bisect_left(self.bounds, key) - 1, 0)
        for s in range(shard, max(bisect_right(self.bounds, key), shard + 1) if self.bounds else 0):
            directory, firsts = self._directory(s)
            for b in range(max(bisect_left(firsts, key) - 1, 0), max(bisect_right(firsts, key), 1)):
                lines, keys = self._lines(directory[b][1:])
                for line in lines[bisect_left(keys, key):bisect_right(keys, key)]:
                    yield parse(self.reader.member(*line[1:]))


def lookup(wanted: DataFrame, where: Archive, key: str = "page_id", url: str = "url", payload: bool = False) -> DataFrame:
    """Captures of the (url, id) pairs in ``wanted``: what their records say, read from the files.

    Repeated pairs are looked up once; a pair without a capture gives no row. Keys are sorted
    over the cluster first, so a task reads its blocks one after another, each once.
    """
    spark = wanted.sparkSession
    kind = dict(wanted.dtypes)[key]
    keys = written(wanted.select(capture_key(F.col(url), F.col(key)).alias("key")).distinct(), "wanted-captures")
    # a key is short, the record behind it is not: tasks are counted by records to read
    n = keys.count()
    tasks = max(1, n // MOST_LOOKUPS, min(n // LEAST_LOOKUPS, 2 * spark.sparkContext.defaultParallelism))
    told = shipped(spark, where)
    fields = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *["payload"] * payload]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = Lookup(told())
        for batch in batches:
            keys = batch["key"].tolist()
            for at in range(0, len(keys), 100):
                rows = [tuple(r[f] for f in fields) for k in keys[at:at + 100] for r in found.find(k)]
                yield pd.DataFrame(rows, columns=fields).astype(object)

    schema = ("page_id string, url string, payload_bytes long, payload_digest string, record_type string, "
              "refers_to string" + ", payload binary" * payload)
    rows = keys.repartitionByRange(tasks, "key").sortWithinPartitions("key").mapInPandas(read, schema)
    return rows.withColumns({"page_id": F.col("page_id").cast(kind), "refers_to": F.col("refers_to").cast(kind)})
