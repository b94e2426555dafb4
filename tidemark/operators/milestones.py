"""Milestones: which dumps bring new chunks, and their neighbours.

A manifest frame has one row per INSERT chunk of a table in a dump: ``[namespace,] tbl_name, dump_ts, seq, md5``.
Dump ordering is computed on the tiny distinct (table, dump) list; chunk comparisons are anti joins on
(table, dump index, md5), never per-dump collected arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.positions import positions

TABLE = ["namespace", "tbl_name"]


def _g(df: DataFrame, group: list[str] | None) -> list[str]:
    return [c for c in (group if group is not None else TABLE) if c in df.columns]


def dump_index(manifest: DataFrame, group: list[str] | None = None) -> DataFrame:
    """(group…, dump_ts, idx): 0-based order of the dumps of each table. One row per dump, so the window is small."""
    g = _g(manifest, group)
    dumps = manifest.select(*g, "dump_ts").distinct()
    return dumps.withColumn("idx", F.dense_rank().over(Window.partitionBy(*g).orderBy("dump_ts")) - 1)


def _indexed_sets(manifest: DataFrame, group: list[str] | None):
    g = _g(manifest, group)
    idx = dump_index(manifest, group)
    s = manifest.select(*g, "dump_ts", "md5").distinct().join(idx, g + ["dump_ts"])
    return g, idx, s


def new_chunks(manifest: DataFrame, group: list[str] | None = None) -> DataFrame:
    """U1 / W1 step: (group…, dump_ts, md5) chunks of each dump absent from the preceding dump."""
    g, _idx, s = _indexed_sets(manifest, group)
    before = s.select(*g, (F.col("idx") + 1).alias("idx"), "md5")
    return s.join(before, g + ["idx", "md5"], "left_anti").select(*g, "dump_ts", "md5")


def removed_chunks(manifest: DataFrame, group: list[str] | None = None) -> DataFrame:
    """(group…, dump_ts, md5) chunks of the preceding dump absent from this dump."""
    g, _idx, s = _indexed_sets(manifest, group)
    before = s.select(*g, (F.col("idx") + 1).alias("idx"), "md5", F.col("dump_ts").alias("prev_dump"))
    cur = s.select(*g, "idx", "md5", "dump_ts")
    dumps = s.select(*g, "idx", "dump_ts").distinct()
    gone = before.join(cur, g + ["idx", "md5"], "left_anti")
    return gone.join(dumps, g + ["idx"]).select(*g, "dump_ts", "md5")


def milestones(manifest: DataFrame, group: list[str] | None = None) -> DataFrame:
    """(group…, dump_ts, n_new) for dumps that bring at least one new chunk."""
    g = _g(manifest, group)
    return new_chunks(manifest, group).groupBy(*g, "dump_ts").agg(F.count(F.lit(1)).alias("n_new"))


def milestone_bounds(manifest: DataFrame, now: int, group: list[str] | None = None) -> DataFrame:
    """(group…, dump_ts, prev_ts, next_ts) with extremes 0 and ``now`` (a parameter: reproducible)."""
    g = _g(manifest, group)
    m = milestones(manifest, group).select(*g, "dump_ts")
    w = Window.partitionBy(*g).orderBy("dump_ts")  # one row per milestone
    return m.select(*g, "dump_ts",
                    F.coalesce(F.lag("dump_ts").over(w), F.lit(0)).cast("bigint").alias("prev_ts"),
                    F.coalesce(F.lead("dump_ts").over(w), F.lit(now)).cast("bigint").alias("next_ts"))


def manifest_changed(manifest: DataFrame, group: list[str] | None = None) -> DataFrame:
    """(group…, dump_ts, n_chunks, changed) — whether the ordered hash list differs from the preceding dump's.

    Lists are compared position by position (distributed positions, full outer join), not as collected arrays."""
    g = _g(manifest, group)
    idx = dump_index(manifest, group)
    p = positions(manifest.select(*g, "dump_ts", "seq", "md5"), g + ["dump_ts"], "seq", "p").join(idx, g + ["dump_ts"])
    cur = p.select(*g, "idx", "p", F.col("md5").alias("m_cur"))
    prev = p.select(*g, (F.col("idx") + 1).alias("idx"), "p", F.col("md5").alias("m_prev"))
    j = cur.join(prev, g + ["idx", "p"], "full")
    mism = j.groupBy(*g, "idx").agg(
        F.sum(F.when(F.col("m_cur").eqNullSafe(F.col("m_prev")), 0).otherwise(1)).alias("_x"),
        F.count("m_cur").alias("n_chunks"))
    return idx.join(mism, g + ["idx"], "left").select(
        *g, "dump_ts", F.coalesce("n_chunks", F.lit(0)).cast("bigint").alias("n_chunks"),
        (F.coalesce("_x", F.lit(0)) > 0).alias("changed"))


def chunks_since(manifest: DataFrame, published: DataFrame, group: list[str] | None = None) -> DataFrame:
    """(group…, dump_ts, baseline_ts, md5) chunks of each dump absent from the latest *published* dump before
    it. ``published`` is the publish log (group…, dump_ts); baseline_ts is null when nothing earlier is published."""
    g = _g(manifest, group)
    # as-of join: dumps and publishes of a table in one order, each dump sees the last publish before it
    staged = manifest.select(*g, "dump_ts").distinct().withColumn("_p", F.lit(None).cast("bigint"))
    log = published.select(*g, F.col("dump_ts").cast("bigint").alias("dump_ts")).distinct().withColumn("_p", F.col("dump_ts"))
    before = Window.partitionBy(*g).orderBy("dump_ts").rangeBetween(Window.unboundedPreceding, -1)
    base = staged.unionByName(log).withColumn("baseline_ts", F.last("_p", ignorenulls=True).over(before)) \
        .filter(F.col("_p").isNull()).drop("_p")
    cur = manifest.select(*g, "dump_ts", "md5").distinct().join(base, g + ["dump_ts"])
    old = manifest.select(*g, F.col("dump_ts").alias("baseline_ts"), "md5").distinct()
    return cur.join(old, g + ["baseline_ts", "md5"], "left_anti").select(*g, "dump_ts", "baseline_ts", "md5")
