"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import work_dir

# ASCII white space \x20 \x09-\x0D: what separates words in every operator here.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, fmt: str = "parquet", **options: str) -> DataFrame:
    """Write ``df`` once into the shared work folder and read it back.

    Unlike ``checkpoint`` the last stage runs once, the files are columnar, and every executor sees them.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.format(fmt).options(**options).save(path)
    return spark.read.format(fmt).schema(df.schema).load(path)


def partitions(df: DataFrame) -> int:
    """Number of shuffle partitions of the session, for explicit repartitioning by key."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` whose workers can import this package: on a cluster it is installed or shipped (``--py-files``);
    a local session's workers get the path of this checkout."""
    sc = df.sparkSession.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if sc.master.startswith("local[") and root not in sc.environment.get("PYTHONPATH", "").split(os.pathsep):
        sc.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, [sc.environment.get("PYTHONPATH")])])
    return df.mapInArrow(fn, schema)


def by_key(df: DataFrame, key: str, fn: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Run ``fn`` on the rows of each ``key`` (non-null), streaming over key-sorted partitions.

    One shuffle, no per-group job; a task holds one group at a time, so callers bound the size of a group.
    """
    at = df.columns.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            col = b.column(at)
            keys = col.to_pylist()
            lo = 0
            for i in range(1, len(keys) + 1):
                if i < len(keys) and keys[i] == keys[lo]:
                    continue
                if held and last != keys[lo]:
                    yield from fn(pa.Table.from_batches(held))
                    held = []
                held.append(b.slice(lo, i - lo))
                last, lo = keys[lo], i
        if held:
            yield from fn(pa.Table.from_batches(held))

    return map_arrow(df.repartition(partitions(df), key).sortWithinPartitions(key), run, schema)
