"""Stage dumps: lines -> content-addressed chunks + per-dump manifest, DDL, views and meta."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import line_md5
from tidemark.operators import statements as S
from tidemark.operators.cells import bounded_broadcast
from tidemark.session import checkpointed

NEW_KEYS_BROADCAST_ROWS = 2_000_000  # new chunk keys (md5 + names, ~100 B each) broadcast below this count


@dataclass
class StagedDump:
    chunks: DataFrame    # namespace, tbl_name, md5, payload, dump_id, seq  (one row per INSERT, duplicates kept)
    manifest: DataFrame  # namespace, dump_ts, tbl_name, seq, md5
    ddl: DataFrame       # namespace, dump_ts, name, stmt
    views: DataFrame     # namespace, dump_ts, name, stmt
    meta: DataFrame      # namespace, dump_ts, status, rowcount, md5
    picks: DataFrame | None = None  # namespace, tbl_name, md5, dump_id, seq: the line that stands for each distinct chunk


def line_metadata(lines: DataFrame) -> DataFrame:
    """One pass over the text: (dump_id, line_no, kind, tbl_name, md5, value) with ``value`` kept for non-INSERT
    lines only — a few dozen bytes per INSERT line instead of its ~16 MB body."""
    k = S.kind("value")
    return lines.select(
        "dump_id", "line_no", k.alias("kind"), S.statement_table("value", k).alias("tbl_name"),
        line_md5("value").alias("md5"),
        F.when(k == "insert", F.lit(None).cast("string")).otherwise(F.col("value")).alias("value"))


def stage_dump(lines: DataFrame, namespace: str, skip_tables: list[str] | None = None,
               forced: dict | None = None, mode: str = "corrected", materialize: bool = True) -> StagedDump:
    """L1 over (dump_id, line_no, value) of one or more dumps. Nothing is written (K10 dry run = use the frames).

    The text is read twice in total: once for the per-line metadata (checkpointed when ``materialize``; manifest,
    DDL, views, counts and fingerprint all come from it) and once, when stored, for the payloads of new chunks."""
    meta_lines = line_metadata(lines)
    if materialize:
        meta_lines = checkpointed(meta_lines)
    ts = S.dump_timestamp(meta_lines, forced).select("dump_id", "dump_ts")
    keep = S.skip_filter(F.col("tbl_name"), skip_tables)
    ns = F.lit(namespace).alias("namespace")
    ins_meta = meta_lines.filter((F.col("kind") == "insert") & keep)
    manifest = ins_meta.select("dump_id", "tbl_name", F.col("line_no").alias("seq"), "md5") \
        .join(ts, "dump_id").select(ns, "dump_ts", "tbl_name", "seq", "md5")
    k = S.kind("value")
    ins = lines.filter((k == "insert") & S.skip_filter(S.statement_table("value", k), skip_tables))
    chunks = ins.select(ns, S.statement_table("value", k).alias("tbl_name"), line_md5("value").alias("md5"),
                        S.insert_payload("value").alias("payload"), "dump_id", F.col("line_no").alias("seq"))
    picks = ins_meta.groupBy("tbl_name", "md5").agg(F.min(F.struct("dump_id", "line_no")).alias("_p")).select(
        ns, "tbl_name", "md5", F.col("_p.dump_id").alias("dump_id"), F.col("_p.line_no").alias("seq"))
    creates = S.create_statements(meta_lines, mode).filter(S.skip_filter(F.col("tbl_name"), skip_tables))
    ddl = creates.join(ts, "dump_id").select(ns, "dump_ts", F.col("tbl_name").alias("name"),
                                             S.create_payload("stmt").alias("stmt"))
    views = meta_lines.filter(F.col("kind") == "view").join(ts, "dump_id").select(
        ns, "dump_ts", F.col("tbl_name").alias("name"), S.view_body("value").alias("stmt"))
    meta = S.row_counts(meta_lines).join(S.fingerprint(meta_lines, md5_col="md5"), "dump_id").join(ts, "dump_id") \
        .select(ns, "dump_ts", F.lit("staged").alias("status"), F.col("rowcount").cast("bigint").alias("rowcount"),
                F.col("line_md5").alias("md5"))
    return StagedDump(chunks, manifest, ddl, views, meta, picks)


def new_chunks_to_store(chunks: DataFrame, existing: DataFrame | None, keys: DataFrame | None = None,
                        picks: DataFrame | None = None) -> DataFrame:
    """K1: chunks whose (namespace, tbl_name, md5) is not stored yet, one payload per md5.

    Keys are compared first (32-byte md5s, taken from ``keys`` — e.g. the manifest, already computed — when given);
    payloads are only moved for new keys (size-checked broadcast of the new key set, else a shuffle join), then
    duplicates inside the batch are dropped. With ``picks``, which name one line per distinct chunk, payloads go from the text
    straight to the caller's write: neither shuffled nor kept twice."""
    key = ["namespace", "tbl_name", "md5"]
    if picks is not None:
        new = picks if existing is None else picks.join(existing.select(*key), key, "left_anti")
        return chunks.join(bounded_broadcast(new.select("dump_id", "seq"), NEW_KEYS_BROADCAST_ROWS), ["dump_id", "seq"], "left_semi")
    if existing is None and keys is None:  # every chunk with a key is new
        return chunks.dropna(subset=key).dropDuplicates(key)
    cur = (keys if keys is not None else chunks).select(*key).distinct()
    new_keys = cur if existing is None else cur.join(existing.select(*key), key, "left_anti")
    payloads = chunks.join(bounded_broadcast(new_keys, NEW_KEYS_BROADCAST_ROWS), key, "left_semi")
    return payloads.dropDuplicates(key)
