"""Rebuild a table's history from all staged dumps in one pass (no per-dump loop).

Rows are exploded once per chunk *appearance* (a chunk new relative to the preceding dump), never once per dump;
a cell is written where its value differs from its previous appearance (lag over the dumps the row is present in).
The window holds one cell's appearances, so it is bounded by the number of milestones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.keys import Key
from tidemark.operators import diff as D
from tidemark.operators import milestones as M
from tidemark.functions.scalars import key_hash
from tidemark.operators.cells import bounded_broadcast, cell_columns, chunk_packed, last_rows, named, unpacked
from tidemark.plans.publish import NEW_CHUNK_BROADCAST_ROWS, Staged, _keys_of
from tidemark.session import checkpointed

Columns = list[str] | dict[int, list[str]]


def _by_columns(chunks: DataFrame, columns: Columns) -> list[tuple[DataFrame, list[str]]]:
    """Chunks with the column list of their dump's DDL: one frame per distinct list (an ALTER makes a new one)."""
    if isinstance(columns, list):
        return [(chunks, columns)]
    lists: dict[tuple[str, ...], list[int]] = {}
    for dump, names in columns.items():
        lists.setdefault(tuple(names), []).append(dump)
    return [(chunks.filter(F.col("dump_ts").isin(dumps)), list(names)) for names, dumps in lists.items()]


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _rows(staged: Staged, appear: DataFrame, columns: Columns, key: Key | None) -> DataFrame:
    """Packed rows, with their cells' columns, of the chunks that appear in a dump; of rows of a dump that share a key the last put counts."""
    seq = staged.manifest.groupBy("dump_ts", "md5").agg(F.max("seq").alias("seq")).join(appear, ["dump_ts", "md5"])
    ch = staged.chunks.select("md5", "payload").join(bounded_broadcast(checkpointed(seq), NEW_CHUNK_BROADCAST_ROWS), "md5")
    keep = ["dump_ts", "md5", "seq"]
    return last_rows(_union([named(chunk_packed(c, names, keep, key), cell_columns(names, key)) for c, names in _by_columns(ch, columns)]),
                     ["dump_ts"])


def _with_previous(cells: DataFrame) -> DataFrame:
    """Cells with the value (_pv), null flag (_pn) and dump (_pd) of their previous appearance."""
    w = Window.partitionBy("_h", "row_key", "column").orderBy("dump_ts")
    return cells.withColumn("_h", key_hash("row_key", "column")).withColumn("_pv", F.lag("value").over(w)) \
        .withColumn("_pn", F.lag("is_null").over(w)).withColumn("_pd", F.lag("dump_ts").over(w))


def rebuild_history(staged: Staged, namespace: str, tbl: str, columns: Columns, literal_nulls: bool = False,
                    key: Key | None = None) -> DataFrame:
    st = staged.table(namespace, tbl)
    rows = _rows(st, M.new_chunks(st.manifest).select("dump_ts", "md5"), columns, key)
    changed = _with_previous(unpacked(rows, None, literal_nulls)).filter(F.col("_pd").isNull() | ~D.same("value", "is_null", "_pv", "_pn"))
    return changed.select("row_key", "row_id", "column", F.col("dump_ts").alias("ts"), "value", "is_null",
                          F.col("dump_ts").alias("publish_id"))


def rebuild_with_deletes(staged: Staged, namespace: str, tbl: str, columns: Columns, literal_nulls: bool = False,
                         key: Key | None = None) -> tuple[DataFrame, DataFrame]:
    """L8 with deletes applied (absence treated as a value): (history, tombstones) equal to publishing every dump
    in order with ``apply_deletes``.

    Row events come from chunk changes only: an *appearance* for rows of a chunk new at a dump, a *removal* for rows
    of a chunk gone at a dump that do not reappear in that dump's new chunks. A removal is a row tombstone; a row
    appearing right after a removal is written in full, otherwise only cells that differ from the previous
    appearance. Windows hold one row's (or cell's) events."""
    st = staged.table(namespace, tbl)
    appear = M.new_chunks(st.manifest).select("dump_ts", "md5")
    gone = M.removed_chunks(st.manifest).select("dump_ts", "md5")
    rows = checkpointed(_rows(st, appear, columns, key))  # parsed once for the events and the cells
    app_rows = rows.select("dump_ts", "row_key")  # one row per dump and key
    if isinstance(columns, dict):  # a chunk that is gone was written under the DDL of the dump before
        dumps = sorted(columns)
        columns = {d: columns[dumps[max(0, i - 1)]] for i, d in enumerate(dumps)}
    lost = st.chunks.select("md5", "payload").join(bounded_broadcast(checkpointed(gone), NEW_CHUNK_BROADCAST_ROWS), "md5")
    rem_rows = checkpointed(_union([_keys_of(c, names, key, ["dump_ts", "md5"]) for c, names in _by_columns(lost, columns)])
                            .select("dump_ts", "row_key", "row_id").distinct().join(app_rows, ["dump_ts", "row_key"], "left_anti"))
    events = rows.withColumn("_removal", F.lit(False)).unionByName(
        rem_rows.select("dump_ts", "row_key").withColumn("_removal", F.lit(True)), allowMissingColumns=True)
    wr = Window.partitionBy("_h", "row_key").orderBy("dump_ts")
    after = events.withColumn("_h", key_hash("row_key")).withColumn("_after_removal", F.coalesce(F.lag("_removal").over(wr), F.lit(False))) \
        .filter(~F.col("_removal") & F.col("row_key").isNotNull()).drop("_h", "_removal")
    c = _with_previous(unpacked(after, None, literal_nulls))
    hist = c.filter(F.col("_pd").isNull() | F.col("_after_removal") | ~D.same("value", "is_null", "_pv", "_pn")) \
        .select("row_key", "row_id", "column", F.col("dump_ts").alias("ts"), "value", "is_null",
                F.col("dump_ts").alias("publish_id"))
    tomb = rem_rows.select("row_key", F.lit(None).cast("string").alias("column"), F.col("dump_ts").alias("ts"),
                           F.col("dump_ts").alias("publish_id"))
    return hist, tomb
