"""Distributed ordinal positions and segment ids (gaps and islands) without a window over a whole group.

A window partitioned by a dump (or table) alone would pull the whole group into one task. Instead rows are split
into ordered buckets: a window inside each bucket gives local positions, a tiny per-bucket table gives each bucket's
offset (its own window holds one row per bucket), and a join adds the offset back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET = 1 << 20  # order-key span of one bucket


def _bucket(order: str, bucket: Column | None, width: int) -> Column:
    return bucket if bucket is not None else F.floor(F.col(order) / F.lit(width)).cast("bigint")


def positions(df: DataFrame, group: list[str], order: str, out: str = "position",
              bucket: Column | None = None, width: int = DEFAULT_BUCKET) -> DataFrame:
    """Adds ``out`` = 0-based rank of ``order`` within ``group`` (order values unique within a group).

    ``bucket`` must be monotone in ``order`` (e.g. the file split of a line); by default order // width."""
    d = df.withColumn("_b", _bucket(order, bucket, width))
    local = d.withColumn("_l", F.row_number().over(Window.partitionBy(*group, "_b").orderBy(order)) - 1)
    counts = d.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    wb = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_o", F.coalesce(F.sum("_n").over(wb), F.lit(0))).drop("_n")
    return local.join(offs, group + ["_b"], "left").withColumn(out, (F.col("_o") + F.col("_l")).cast("bigint")) \
        .drop("_b", "_l", "_o")


def segment_start(df: DataFrame, group: list[str], order: str, flag: str, out: str = "segment",
                  bucket: Column | None = None, width: int = DEFAULT_BUCKET) -> DataFrame:
    """Adds ``out`` = order value of the last row with ``flag`` true at or before this row (null if none).

    This is the 'running segment id' of a gaps-and-islands pass, computed bucket-locally plus a carry-in."""
    d = df.withColumn("_b", _bucket(order, bucket, width))
    w = Window.partitionBy(*group, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = d.withColumn("_s", F.last(F.when(F.col(flag), F.col(order)), ignorenulls=True).over(w))
    lasts = d.groupBy(*group, "_b").agg(F.max(F.when(F.col(flag), F.col(order))).alias("_m"))
    wb = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = lasts.withColumn("_c", F.max("_m").over(wb)).drop("_m")
    return local.join(carry, group + ["_b"], "left").withColumn(out, F.coalesce("_s", "_c")) \
        .drop("_b", "_s", "_c")
