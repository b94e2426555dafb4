"""tidemark — versioned history of repeated SQL dumps, built on Spark.

Layers:
  functions/  Column expressions (hashing, padding, time parsing, tuple and DDL parsing, typed reads)
  sources/    dump-text scans, list files, staging-store lookups, fixtures derived from Parquet tables
  operators/  DataFrame -> DataFrame building blocks (statements, cells, history, milestones, diff)
  plans/      user-facing pipelines (stage a dump, publish, read as of, rebuild, catalogue)
  streaming/  landing-directory ingestion with Structured Streaming
"""

__version__ = "0.1.0"
