"""Token ids in ORC files: one row per document, in id order, read back stripe by stripe.

Files hold (doc_id, ids, n_tokens, part, before): ``part`` numbers the file in id order and ``before`` counts the
tokens of the documents before it in the file, so a document's global start is a file offset plus ``before`` and
needs no global window. ORC gives integer run-length encoding of the ids, row indexes, Bloom filters on ``doc_id`` and
stripes that tasks read in parallel; a lookup by id skips stripes by their statistics and filters.

Defined results: null and empty texts hold the end id alone; a null ``doc_id`` comes first (it is written and read
back as null); rows repeating an id follow each other in the order of their texts' hashes; ids are spread over files
by (id, hash), so a repeated id is no hot partition; extra columns are ignored; an empty table writes no rows and
gives no rows. Texts are encoded whole.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from .common import map_arrow
from .wordcache import Encoder, encoder
from tidemark.session import work_dir

SCHEMA = "doc_id long, ids array<int>, n_tokens long, part int, before long"
OPTIONS = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true",
           "orc.row.index.stride": "10000", "orc.stripe.size": str(64 << 20), "compression": "zstd"}


def encoded(batches: Iterator[pa.RecordBatch], enc: Encoder, end: int, part: int) -> Iterator[pa.RecordBatch]:
    """Rows of file ``part`` for batches of (doc_id, text); ids go from the encoder's slices to the rows as arrays."""
    before = 0
    for b in batches:
        at = 0
        for ids, ends in enc.slices(b.column(1)):
            ids, ends = np.insert(ids.view("<i4"), ends, end), ends + np.arange(1, len(ends) + 1)
            n = np.diff(ends, prepend=0)
            yield pa.RecordBatch.from_arrays([
                b.column(0).slice(at, len(n)), pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), pa.array(ids)),
                pa.array(n), pa.array(np.full(len(n), part, np.int32)), pa.array(before + ends - n)],
                names=["doc_id", "ids", "n_tokens", "part", "before"])
            before, at = before + len(ids), at + len(n)


def write_ids(docs: DataFrame, path: str, tokenizer: str, end: int, id_col: str = "doc_id", text: str = "text") -> None:
    """Encode every text, append ``end`` and write ORC files in ascending id order under ``path``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return encoded(batches, encoder(tokenizer), end, TaskContext.get().partitionId())

    ranged = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    map_arrow(ranged, run, SCHEMA).write.options(**OPTIONS).orc(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids, n_tokens, part, before) of the files under ``path``."""
    return spark.read.schema(SCHEMA).orc(path)


def starts(rows: DataFrame) -> DataFrame:
    """(part, offset): tokens before each file; one row a file, read from two small columns."""
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("t"))
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("part", F.coalesce(F.sum("t").over(w), F.lit(0)).alias("offset"))


def lookup(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """Rows of a few documents; the predicate reaches the ORC reader, which prunes files, stripes and row groups."""
    return read_ids(spark, path).where(F.col("doc_id").isin(ids))


def digest(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of rows read back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(1)
            off = ids.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            crc = [zlib.crc32(raw[4 * lo:4 * hi]) for lo, hi in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), pa.array(np.diff(off).astype(np.int64)),
                                              pa.array(crc, pa.int64())],
                                             names=["doc_id", "part", "before", "n_tokens", "ids_crc32"])

    read = map_arrow(rows.select("doc_id", "ids", "part", "before"), run,
                     "doc_id long, part int, before long, n_tokens long, ids_crc32 long")
    return read.join(starts(rows), "part").select(
        "doc_id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def op3(docs: DataFrame, tokenizer: str, end: int = 2) -> DataFrame:
    spark = docs.sparkSession
    path = f"{work_dir(spark)}/ids-{uuid.uuid4().hex}"
    write_ids(docs, path, tokenizer, end)
    return digest(read_ids(spark, path))
