"""Snapshot diff of incoming chunk rows against the published state before and after the dump (J2-J7, J12, J13,
A6-A8).

Frames:
  incoming  row_key, row_id, column, value, is_null[, md5]   cells of the dump's new chunks
  prev      state as of the previous bound (history.asof) — row_key, column, ts, value, is_null
  nxt       state as of the next published dump, or None
All comparisons are null-safe on (value, is_null); absence is tested on a marker column, never on the value.
Every join is an equi join on (row_key, column) or row_key, so incoming is shuffled once and the partitioning is
reused; the only non-equi join (literal chunk ranges) meets by rank blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import key_hash

KEY = ["row_key", "column"]
HASHED = ["_h", *KEY]  # joins of cells sort by the hash
RANK_BLOCK = 1024  # key ids of one block of a range join


def same(a_val: str, a_null: str, b_val: str, b_null: str) -> Column:
    return F.col(a_val).eqNullSafe(F.col(b_val)) & F.col(a_null).eqNullSafe(F.col(b_null))


def _hashed(cells: DataFrame) -> DataFrame:
    return cells if "_h" in cells.columns else cells.withColumn("_h", key_hash(*KEY))


def _side(state: DataFrame, p: str) -> DataFrame:
    return _hashed(state).select(*HASHED, F.lit(True).alias(f"{p}_present"), F.col("ts").alias(f"{p}_ts"),
                        F.col("value").alias(f"{p}_value"), F.col("is_null").alias(f"{p}_is_null"))


@dataclass
class Diff:
    writes: DataFrame       # ts=when cells to put
    deletes: DataFrame      # (ts, row_key, row_id, column=null) rows gone at when
    redundant: DataFrame    # (ts, row_key, row_id, column|null) future cells/rows identical to incoming
    restores: DataFrame     # (ts=next, row_key, row_id, column, value, is_null) corrected mode only
    changed: DataFrame      # J3 before suppression (md5 of the incoming chunk kept)
    identical_next: DataFrame  # J5
    full_rows: DataFrame    # J6: rows whose next-state cells are all identical to incoming
    chunk_rows: DataFrame | None = None  # A7: (md5, n_incoming, n_prev, n_next) rows of a chunk, and those in either state

    def tagged(self) -> DataFrame:
        """One frame with change_kind in (write, delete, redundant, restore)."""
        cols = ["ts", "row_key", "row_id", "column", "value", "is_null"]

        def norm(df, kind):
            d = df
            for c in cols:
                if c not in d.columns:
                    d = d.withColumn(c, F.lit(None).cast("boolean" if c == "is_null" else "string"))
            return d.select(F.lit(kind).alias("change_kind"), F.col("ts").cast("bigint").alias("ts"), "row_key",
                            F.col("row_id").cast("bigint").alias("row_id"), F.col("column").cast("string"),
                            F.col("value").cast("string"), F.col("is_null").cast("boolean"))
        return (norm(self.writes, "write").unionByName(norm(self.deletes, "delete"))
                .unionByName(norm(self.redundant, "redundant")).unionByName(norm(self.restores, "restore")))


def ranked(keys: DataFrame, ranges: DataFrame) -> DataFrame:
    """(v, is_key, before): every key id and range end with the number of distinct key ids before it.

    A sweep over the sorted ends and keys in range partitions: counts run inside a partition, and what is open at its border is
    carried in from the partitions before it (one row each)."""
    from tidemark.session import checkpointed
    ends = ranges.select(F.explode(F.array("first_id", "last_id")).alias("v"), F.lit(0).alias("is_key"))
    points = keys.select(F.col("row_id").alias("v"), F.lit(1).alias("is_key")).unionByName(ends).filter(F.col("v").isNotNull()) \
        .groupBy("v").agg(F.max("is_key").alias("is_key"))
    # written once, so that the partition numbers hold
    p = checkpointed(points.repartitionByRange("v").select("v", "is_key", F.spark_partition_id().alias("_p")))
    own = Window.partitionBy("_p").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    border = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    carried = p.groupBy("_p").agg(F.sum("is_key").alias("_n")).select("_p", F.coalesce(F.sum("_n").over(border), F.lit(0)).alias("_o"))
    return p.withColumn("_b", F.coalesce(F.sum("is_key").over(own), F.lit(0))).join(F.broadcast(carried), "_p").select(
        "v", "is_key", (F.col("_o") + F.col("_b")).alias("before"))


def range_join(ranges: DataFrame, keys: DataFrame, block: int = RANK_BLOCK) -> DataFrame:
    """Rows of ``keys`` (row_id…) inside each [first_id, last_id] of ``ranges``.

    Ids become ranks among the key ids, so a range is as wide as the keys it holds, whatever the gaps between ids (a chunk with
    the ids 1 and 10^15 is no wider than two keys). Ranges meet keys in blocks of ``block`` ranks: a range is listed once per
    block it covers, which is at most its result divided by ``block``, and twice for the ends."""
    rank = ranked(keys, ranges)
    first = rank.select(F.col("v").alias("first_id"), F.col("before").alias("_lo"))
    last = rank.select(F.col("v").alias("last_id"), (F.col("before") + F.col("is_key") - 1).alias("_hi"))
    r = ranges.join(first, "first_id").join(last, "last_id").filter(F.col("_lo") <= F.col("_hi"))
    at = lambda c: F.floor(F.col(c) / block).cast("bigint")
    r = r.withColumn("_bk", F.explode(F.sequence(at("_lo"), at("_hi"))))
    k = keys.join(rank.select(F.col("v").alias("row_id"), F.col("before").alias("_rank")), "row_id").withColumn("_bk", at("_rank"))
    return r.join(k, "_bk").filter(F.col("_rank").between(F.col("_lo"), F.col("_hi"))).drop("_bk", "_lo", "_hi", "_rank")


def diff(incoming: DataFrame, prev: DataFrame, nxt: DataFrame | None, when: int, next_ts: int | None = None,
         mode: str = "corrected", removed_keys: DataFrame | None = None,
         prev_in_chunk: DataFrame | None = None, materialize: bool = False) -> Diff:
    """Compare incoming cells with prev/next state.

    corrected: every changed or new cell is written; deletes = keys of removed chunks absent from incoming
      (``removed_keys``); cells identical to a *future* next value are reported as redundant but still written;
      written cells whose next-state value is older than ``when`` and different are restored at ``next_ts``.
    literal: a new row is written only when its chunk had no previous rows; rows fully identical to the next state
      are not written; deletes = previous rows of the chunk's id range absent from the chunk
      (``prev_in_chunk``: md5, row_key, row_id)."""
    inc = incoming
    j = _hashed(inc).join(_side(prev, "p"), HASHED, "left")
    changed = j.filter(~F.coalesce(same("value", "is_null", "p_value", "p_is_null") & F.col("p_present"),
                                   F.lit(False))).select(*inc.columns)
    if materialize:  # read by the writes, the restores and the reports: join once
        from tidemark.session import checkpointed
        changed = checkpointed(changed)
    writes = changed
    if mode == "literal":
        if prev_in_chunk is None:
            raise ValueError("literal mode needs prev_in_chunk")
        chunk_prev = prev_in_chunk.select("md5").distinct().withColumn("_chunk_has_prev", F.lit(True))
        row_prev = prev.select("row_key").distinct().withColumn("_row_in_prev", F.lit(True))
        writes = writes.join(chunk_prev, "md5", "left").join(row_prev, "row_key", "left").filter(
            F.col("_row_in_prev").isNotNull() | F.col("_chunk_has_prev").isNull())

    empty_ref = inc.select("row_key", "row_id").limit(0)
    if nxt is not None:
        n = _side(nxt, "n")
        ident = _hashed(inc).join(n, HASHED).filter(same("value", "is_null", "n_value", "n_is_null"))
        n_cells = nxt.groupBy("row_key").agg(F.count(F.lit(1)).alias("_n_cells"))
        per_row = ident.groupBy("row_key").agg(
            F.count(F.lit(1)).alias("_n_same"), F.max("row_id").alias("row_id"),
            F.min_by("n_ts", "column").alias("_pick_ts"), F.max("md5").alias("md5"))
        # compare as a difference: an equality of the two counts would become a second join key and re-shuffle
        # both row-keyed aggregates; this way the join on row_key reuses their partitioning
        full = per_row.join(n_cells, "row_key").filter((F.col("_n_same") - F.col("_n_cells")) == 0)
        full_keys = full.select("row_key").withColumn("_full", F.lit(True))
        full_rows = full.select("row_key", "row_id")
        tagged = ident.join(full_keys, "row_key", "left")
        if mode == "literal":
            red_rows = full.filter(F.col("_pick_ts") > when).select(
                F.col("_pick_ts").alias("ts"), "md5", "row_key", "row_id", F.lit(None).cast("string").alias("column"))
            writes = writes.join(full_keys, "row_key", "left_anti")
        else:
            red_rows = tagged.filter(F.col("_full").isNotNull() & (F.col("n_ts") > when)).select(
                F.col("n_ts").alias("ts"), "md5", "row_key", "row_id", F.lit(None).cast("string").alias("column")
            ).distinct()
        red_cells = tagged.filter(F.col("_full").isNull() & (F.col("n_ts") > when)).select(
            F.col("n_ts").alias("ts"), "md5", "row_key", "row_id", "column")
        redundant = red_rows.unionByName(red_cells)
        identical_next = ident.select("row_key", "row_id", "column", "value", "is_null", "n_ts")
    else:
        redundant = empty_ref.select(F.lit(None).cast("bigint").alias("ts"), F.lit(None).cast("string").alias("md5"),
                                     "row_key", "row_id",
                                     F.lit(None).cast("string").alias("column"))
        identical_next = inc.limit(0).select("row_key", "row_id", "column", "value", "is_null",
                                             F.lit(None).cast("bigint").alias("n_ts"))
        full_rows = empty_ref

    if mode == "literal":
        inc_keys = inc.select("md5", "row_key").distinct()
        deletes = prev_in_chunk.join(inc_keys, ["md5", "row_key"], "left_anti").select(
            F.lit(when).cast("bigint").alias("ts"), "md5", "row_key", "row_id", F.lit(None).cast("string").alias("column")
        ).distinct()
    elif removed_keys is not None:
        deletes = removed_keys.select("md5", "row_key", "row_id").distinct().join(
            inc.select("row_key").distinct(), "row_key", "left_anti").select(
            F.lit(when).cast("bigint").alias("ts"), "md5", "row_key", "row_id", F.lit(None).cast("string").alias("column"))
    else:
        deletes = empty_ref.select(F.lit(None).cast("bigint").alias("ts"), F.lit(None).cast("string").alias("md5"),
                                   "row_key", "row_id",
                                   F.lit(None).cast("string").alias("column"))

    if mode == "corrected" and nxt is not None and next_ts is not None:
        n = _side(nxt, "n")
        restores = _hashed(writes.select("row_key", "row_id", "column", "value", "is_null")).join(n, HASHED).filter(
            (F.col("n_ts") < when) & ~same("value", "is_null", "n_value", "n_is_null")).select(
            F.lit(next_ts).cast("bigint").alias("ts"), "row_key", "row_id", "column",
            F.col("n_value").alias("value"), F.col("n_is_null").alias("is_null"))
    else:
        restores = inc.limit(0).select(F.lit(None).cast("bigint").alias("ts"), "row_key", "row_id", "column",
                                       "value", "is_null")

    writes = writes.select(F.lit(when).cast("bigint").alias("ts"), "row_key", "row_id", "column", "value", "is_null")
    keep = [c for c in ["md5", "row_key", "row_id", "column", "value", "is_null"] if c in changed.columns]
    changed = changed.select(*keep)
    rows = inc.select("md5", "row_key").distinct()
    known = lambda state, name: state.select("row_key").distinct().withColumn(name, F.lit(1))
    rows = rows.join(known(prev, "_p"), "row_key", "left")
    rows = rows.join(known(nxt, "_n"), "row_key", "left") if nxt is not None else rows.withColumn("_n", F.lit(None).cast("int"))
    per_chunk = rows.groupBy("md5").agg(F.count(F.lit(1)).alias("n_incoming"), F.count("_p").alias("n_prev"), F.count("_n").alias("n_next"))
    return Diff(writes, deletes, redundant, restores, changed, identical_next, full_rows, per_chunk)


def delete_counts(deletes: DataFrame) -> DataFrame:
    """(ts, n_deletes) — delete candidates per timestamp."""
    return deletes.groupBy("ts").agg(F.count(F.lit(1)).alias("n_deletes"))


def doomed_lists(doomed: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by…, n, doomed) with doomed = 'key[:column]' entries sorted and comma-joined.

    Grouped per (ts, chunk md5) by default: a list then holds at most one INSERT chunk's rows, so the collect is
    bounded; the unbounded per-timestamp list is the long frame itself (ordered by ts, row_id)."""
    by = by or ["ts", "md5"]
    e = F.concat(F.coalesce(F.col("row_id").cast("string"), F.col("row_key")),  # a string key has no row_id
                 F.when(F.col("column").isNotNull(), F.concat(F.lit(":"), F.col("column"))).otherwise(F.lit("")))
    return doomed.groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                                   F.array_join(F.array_sort(F.collect_list(e)), ",").alias("doomed"))
