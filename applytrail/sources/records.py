"""Records of large text files, read by byte ranges.

A reader that needs a whole file gives it to one task. Here a file is cut at a separator by
as many tasks as it has ranges. Not every separator ends a record, so what was cut too often
is joined again. That is told from a few numbers per piece; texts are shuffled only where
pieces are joined, and records that are one piece, nearly all, stay where they were read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from applytrail.sources import scratch
from applytrail.sources.scratch import cut

# Bytes. Files up to this size are read whole, one task each: a choice of speed, not of rows.
LARGE = 4 * 1024 * 1024

# Bytes of pieces in a stored row, at most some: readers hold thousands of rows at once.
CHUNK = 16 * 1024

PACKED = ("file string, size long, start long, at long, before_0 long, before_1 long, odd int, bytes long, "
          "ends_0 array<int>, ends_1 array<int>, values array<string>")

COMPRESSED = r"(?i)\.(gz|bz2|deflate|lz4|snappy|zst|zstd)$"


def is_large(limit: int = LARGE) -> Column:
    """Whether a file is worth reading by ranges. Compressed ones have no ranges to read by."""
    return (F.col("_metadata.file_size") > limit) & ~F.col("_metadata.file_name").rlike(COMPRESSED)


def pieces(spark: SparkSession, path: str | list[str], separator: str, limit: int = LARGE) -> DataFrame:
    """(file, size, start, at, value): what lies between separators in the large files.

    ``start`` is where the range begins; ``at`` orders the pieces of a range.
    """
    scan = spark.read.option("lineSep", separator).text(path).where(is_large(limit))
    return scan.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"), "value")


def _packed(separator: int):
    """Pieces of a range, as they come, in rows of some ``CHUNK`` bytes; a range's pieces come in one task, in their order.

    A row holds the places of the pieces that close a record, and how many did before it in its range, if the
    range begins at even (``_0``) and if it begins at odd parity (``_1``).
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, odd, before = None, 0, [0, 0]
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            file, start = batch.column("file").dictionary_encode(), batch.column("start").to_numpy(zero_copy_only=False)
            names = file.indices.to_numpy(zero_copy_only=False)
            sizes = batch.column("bytes").to_numpy(zero_copy_only=False).astype(np.int64) + separator
            turns = batch.column("odd").to_numpy(zero_copy_only=False).astype(np.int64)
            if_even, if_odd = (batch.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("if_even", "if_odd"))
            filled = np.cumsum(sizes) // CHUNK
            other = (np.diff(names) != 0) | (np.diff(start) != 0)
            edges = np.concatenate(([0], np.flatnonzero(other | (np.diff(filled) != 0)) + 1, [n]))
            rows, ends, closes = [], ([], []), ([], [])
            for first, last in zip(edges.tolist(), edges[1:].tolist()):
                if of != (here := (file.dictionary[int(names[first])].as_py(), int(start[first]))):
                    of, odd, before = here, 0, [0, 0]
                turned = (odd + np.cumsum(turns[first:last])) % 2 == 1
                closed = (np.where(turned, if_odd[first:last], if_even[first:last]), np.where(turned, if_even[first:last], if_odd[first:last]))
                rows.append((*of, *before, int(turns[first:last].sum() % 2), int(sizes[first:last].sum())))
                odd = int(turned[-1])
                for k in (0, 1):
                    closes[k].append(np.flatnonzero(closed[k]).astype(np.int32) + 1)
                    ends[k].append(len(closes[k][-1]))
                    before[k] += ends[k][-1]
            of_rows = [pa.array(x) for x in zip(*rows)]
            firsts = pa.array(edges[:-1])
            lists = [pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(ends[k]))).astype(np.int32)), pa.array(np.concatenate(closes[k]).astype(np.int32))) for k in (0, 1)]
            values = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), batch.column("value"))
            yield pa.RecordBatch.from_arrays([
                of_rows[0].cast(pa.string()), batch.column("size").take(firsts), of_rows[1].cast(pa.int64()), batch.column("at").take(firsts),
                of_rows[2].cast(pa.int64()), of_rows[3].cast(pa.int64()), of_rows[4].cast(pa.int32()), of_rows[5].cast(pa.int64()), *lists, values],
                names=[c.split()[0] for c in PACKED.split(", ")])
    return pack


def joined(parts: DataFrame, separator: str, closes: Callable[[Column], Column],
           weight: Column | None = None) -> DataFrame:
    """(value, first): the records, separators in and after them kept as the file has them.

    ``closes`` tells whether the separator after a piece ends its record. Its argument is the
    parity of the sum of ``weight`` over the file, this piece included, which no task knows
    alone: each range counts for both parities at its start, and a sum over ranges decides.
    ``first`` marks the record that begins the file. A file's last record may have no
    separator; the file's size tells.
    """
    told = parts.select("file", "size", "start", "at", "value", ((weight if weight is not None else F.lit(0)) % 2).alias("odd"),
                        closes(F.lit(0)).alias("if_even"), closes(F.lit(1)).alias("if_odd"), F.octet_length("value").alias("bytes"))
    chunks = cut(told.mapInArrow(_packed(len(separator.encode())), PACKED), "pieces")
    ranges = chunks.groupBy("file", "start").agg(
        F.sum("odd").alias("odd"), F.sum(F.size("ends_0")).alias("n_0"), F.sum(F.size("ends_1")).alias("n_1"),
        F.sum("bytes").alias("taken"), F.max("size").alias("size"), F.max("at").alias("last_at"), F.sum(F.size("values")).alias("pieces"))
    file = Window.partitionBy("file").orderBy("start")
    earlier = file.rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("odd_start", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2 == 1).withColumn(
        "n", F.when(F.col("odd_start"), F.col("n_1")).otherwise(F.col("n_0")))
    # few and stored, so the planner knows how small they are and need not shuffle the texts to meet them
    ranges = cut(ranges.select(
        "file", "start", "odd_start", "last_at", "pieces", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"),
        F.lead("start").over(file).isNull().alias("tail_range"),
        (F.max("size").over(Window.partitionBy("file")) >= F.sum("taken").over(Window.partitionBy("file"))).alias("ends_in_separator")), "pieces-ranges")

    def of_parity(name: str) -> Column:
        return F.when(F.col("odd_start"), F.col(f"{name}_1")).otherwise(F.col(f"{name}_0"))

    known = chunks.join(ranges, ["file", "start"]).select(
        "file", "start", "at", "values", F.size("values").alias("n"), (F.col("offset") + of_parity("before")).alias("record"), of_parity("ends").alias("ends"),
        (F.col("tail_range") & (F.col("at") == F.col("last_at")) & ~F.col("ends_in_separator")).alias("bare"))

    def text(after: Column, last: Column) -> Column:
        """The pieces after one up to another."""
        return F.concat(F.array_join(F.slice("values", after + 1, last - after), separator),
                        F.when(F.col("bare") & (last == F.col("n")), F.lit("")).otherwise(F.lit(separator)))

    def part(record: Column, after: Column, last: Column) -> Column:
        return F.struct(record.cast("long").alias("record"), text(after, last).alias("value"))

    # records that end in a row are whole, but for the first; what is before its first and after its last end is a part
    closed, none = F.size("ends"), F.lit(0)
    between = F.arrays_zip(F.slice("ends", F.lit(1), F.greatest(closed - 1, none)).alias("after"), F.slice("ends", F.lit(2), F.greatest(closed - 1, none)).alias("last"))
    # dealt by their number, not by bytes, which compress well: no task has more than its share
    tasks = max(chunks.sparkSession.sparkContext.defaultParallelism, -(-(ranges.agg(F.sum("pieces")).first()[0] or 0) // scratch.TASK_ROWS))
    whole = known.repartition(tasks, "at").select(F.explode(F.transform(between, lambda r: text(r["after"], r["last"]))).alias("value"), F.lit(False).alias("first"))
    opened = F.coalesce(F.try_element_at("ends", F.lit(1)), F.col("n"))
    rest = F.coalesce(F.try_element_at("ends", F.lit(-1)), F.col("n"))
    pairs = F.array(part(F.col("record"), none, opened), F.when(rest < F.col("n"), part(F.col("record") + closed, rest, F.col("n"))))
    parts_of = known.select("file", "start", "at", F.explode(pairs).alias("part")).where("part IS NOT NULL").select(
        "file", "start", "at", "part.record", "part.value").repartition(tasks, "file", "record")
    mended = parts_of.groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("start", "at", "value"))).alias("of"))
    return whole.union(mended.select(F.array_join("of.value", "").alias("value"), (F.col("record") == 0).alias("first")))
