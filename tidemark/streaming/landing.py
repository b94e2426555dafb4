"""Structured Streaming ingestion of dump files dropped into a landing directory (optional extension of L1/K1).

Each new file is one dump. The file source hands every file whole to one micro-batch, so a batch can be staged like
a static scan: line order comes from (file, split, row order), line numbers from per-split offsets. Chunk dedup
state lives in the Parquet chunk table (anti join per batch), not in the streaming state store, so it does not grow
with the number of dumps ever seen. Progress is tracked in the query checkpoint (a shared folder): a lost executor
or a restarted driver resumes without re-staging finished files; a re-run batch overwrites the same dump partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import line_md5
from tidemark.operators import statements as S
from tidemark.sources.dumpfile import number_splits
from tidemark.plans.stage import stage_dump
from tidemark.plans.store import Store


def landing_lines(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of raw lines with their file position metadata."""
    r = spark.readStream.format("text").option("lineSep", "\n")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(landing).select("value", F.col("_metadata.file_path").alias("_f"),
                                  F.col("_metadata.file_block_start").alias("_s"))


def number_lines(batch: DataFrame) -> DataFrame:
    """(dump_id = file path, line_no, value) for one micro-batch (per-split offsets, text not shuffled)."""
    b = batch.withColumn("_m", F.monotonically_increasing_id()).withColumn("dump_id", F.col("_f"))
    return number_splits(b).select("dump_id", "line_no", "value")


def start_ingest(spark: SparkSession, landing: str, store: Store, namespace: str, checkpoint: str,
                 skip_tables: list[str] | None = None, available_now: bool = True):
    """Stage every dump file landing in ``landing`` into ``store``. Returns the StreamingQuery."""
    def per_batch(batch: DataFrame, epoch: int) -> None:
        if batch.isEmpty():
            return
        store.stage(stage_dump(number_lines(batch), namespace, skip_tables))

    w = landing_lines(spark, landing).writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def chunk_keys_stream(lines: DataFrame, namespace: str) -> DataFrame:
    """K1 as a streaming operator: first sighting of each (table, chunk md5) across all landed dumps.

    Uses the streaming state store for the seen keys (32-byte md5s, no payload): use it for monitoring new content;
    the store itself dedups against the Parquet chunk table."""
    k = lines.withColumn("kind", S.kind("value")).filter(F.col("kind") == "insert")
    return k.select(F.lit(namespace).alias("namespace"), S.statement_table("value", "kind").alias("tbl_name"),
                    line_md5("value").alias("md5"), F.col("_f").alias("dump_file")).dropDuplicates(
        ["namespace", "tbl_name", "md5"])
