"""Dump files: distributed line scan with exact line numbers (S1), list files (S17), whole-file md5 (A3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.cells import bounded_broadcast
from tidemark.operators.positions import positions
from tidemark.session import checkpointed

LINE_BUCKET = 16  # order values of one bucket of text lines: an INSERT line may have 16 MB
PART_BYTES = 64 << 20  # text of one part file of a dump, about
SPLIT_BROADCAST_ROWS = 1_000_000  # one row per file split: 1M splits = 128 TB of text at 128 MB per split


def number_splits(raw: DataFrame, dump_col: str = "dump_id") -> DataFrame:
    """Dense 0-based ``line_no`` for rows carrying (_f file path, _s split start, _m monotonically_increasing_id).

    Rows of one split are contiguous inside one partition and their ids are consecutive, so a line's number is the
    line count of all earlier splits of its dump plus its distance from the split's first id. Only a per-split
    summary (one row per split) is aggregated and windowed; the text itself is never shuffled."""
    splits = raw.groupBy(dump_col, "_f", "_s").agg(F.min("_m").alias("_m0"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(dump_col).orderBy("_f", "_s").rowsBetween(Window.unboundedPreceding, -1)
    offs = splits.withColumn("_o", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    offs = bounded_broadcast(checkpointed(offs), SPLIT_BROADCAST_ROWS)  # written once: later passes don't redo it
    return raw.join(offs, [dump_col, "_f", "_s"]).withColumn(
        "line_no", (F.col("_o") + F.col("_m") - F.col("_m0")).cast("bigint")).drop("_o", "_m0")


def scan_dump(spark: SparkSession, path: str, dump_id: str | int) -> DataFrame:
    """(dump_id, line_no, value) of every line of a dump file or a directory of ordered part files.

    Order key = (file path, split start, row order within the split): splits are read in parallel and keep their
    partitioning; line numbers come from per-split offsets (no shuffle of the text, no single-task window).
    Only '\\n' ends a line (a bare '\\r' stays in the text). ``.gz`` files are decompressed natively."""
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.lit(dump_id).alias("dump_id"), "value", F.col("_metadata.file_path").alias("_f"),
        F.col("_metadata.file_block_start").alias("_s"), F.monotonically_increasing_id().alias("_m"))
    return number_splits(raw).select("dump_id", "line_no", "value")


def scan_dumps(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """S1 for many dumps in one job: every file is one dump, ``dump_id`` = its path. Line numbers restart per file."""
    raw = spark.read.option("lineSep", "\n").text(paths).select(
        "value", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_s"),
        F.monotonically_increasing_id().alias("_m")).withColumn("dump_id", F.col("_f"))
    return number_splits(raw).select("dump_id", "line_no", "value")


def dense_lines(lines: DataFrame, order: str = "ord") -> DataFrame:
    """Dense 0-based line numbers for a (dump_id, ord, value) frame whose ord has gaps."""
    return positions(lines, ["dump_id"], order, "line_no", width=LINE_BUCKET).select("dump_id", "line_no", "value")


def write_dump(lines: DataFrame, path: str, parts: int = 4) -> str:
    """Write (…, ord, value) lines as ordered text part files (range-partitioned, part names follow ord): at least ``parts``,
    and as many as the text needs for parts of about ``PART_BYTES``."""
    parts = max(parts, -(-(lines.agg(F.sum(F.octet_length("value"))).first()[0] or 0) // PART_BYTES))
    lines.repartitionByRange(parts, "ord").sortWithinPartitions("ord").select("value").write.mode(
        "overwrite").option("lineSep", "\n").text(path)
    return path


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """include/exclude list file — one table per line, trimmed, blank lines dropped."""
    return spark.read.text(path).select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("tbl_name")).filter(
        F.col("tbl_name") != "")


def file_md5(spark: SparkSession, path: str) -> DataFrame:
    """A3 exact form: md5 of the raw bytes of each file (binaryFile reads a file whole: files < 2 GB)."""
    return spark.read.format("binaryFile").load(path).select("path", F.md5("content").alias("md5"), "length")
