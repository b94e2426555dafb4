"""Session helpers: a tuned SparkSession for local runs and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "tidemark", cores: int | str = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """Session used by tests and bench. On a cluster, pass your own session instead."""
    parts = shuffle_partitions or int(os.environ.get("TIDEMARK_SHUFFLE_PARTITIONS", "8"))
    b = SparkSession.builder
    log_dir = os.environ.get("TIDEMARK_EVENT_LOG_DIR")  # stage/task timings without the UI (opt-in)
    if log_dir:
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
    spark = (
        b.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for materialised intermediates.

    Uses the cluster's ``spark.checkpoint.dir`` (read from the session). Only when it is unset in a local session —
    tests — a private folder is created and registered; on a cluster an unset folder is an error, because executors
    would not see a folder of the driver.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if not cur:
        cur = spark.conf.get("spark.checkpoint.dir", None)
        if not cur:
            if not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            cur = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        sc.setCheckpointDir(cur)
        cur = sc.getCheckpointDir() or cur
    return cur


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage: the rows are written to the shared folder (survives executor loss) as compressed Parquet, so that each
    later read fetches only the columns it needs. The files stay until the folder is removed."""
    path = f"{work_dir(df.sparkSession)}/frame-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
