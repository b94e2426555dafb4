"""Versioned cell history: as-of reads, version listings, tombstones, wide state.

A history frame has one row per cell version: ``row_key, row_id, column, ts, value, is_null`` (plus any partition
columns such as ``namespace, tbl_name, publish_id``). Reads never collect: the latest version per cell is a partial +
final aggregate, so versions of a cell collapse map-side before the shuffle on (row_key, column).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import key_hash

CELL_KEY = ["row_key", "column"]
MAX_VERSIONS = 999  # versions kept per published cell


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def latest(cells: DataFrame, group: list[str] | None = None) -> DataFrame:
    """A5: newest version per cell (row_key, column [, group…]) with its own ts; of versions with the same ts the one
    with the greatest value, so a read never picks by chance."""
    group = group or []
    keys = group + CELL_KEY
    return cells.groupBy(*keys).agg(F.max(F.struct("ts", "value", "is_null", "row_id")).alias("v")).select(
        *keys, F.col("v.row_id").alias("row_id"), F.col("v.ts").alias("ts"), F.col("v.value").alias("value"),
        F.col("v.is_null").alias("is_null"),
    )


def asof(cells: DataFrame, ts=None, group: list[str] | None = None) -> DataFrame:
    """State as of ``ts`` (inclusive upper bound; a store read 'timestamp=T' is ``asof(T-1)``).

    ``ts`` may be a literal or a column (for bound-per-row reads after a join)."""
    if ts is not None:
        cells = cells.filter(F.col("ts") <= (ts if isinstance(ts, Column) else F.lit(ts)))
    return latest(cells, group)


def range_scan(cells: DataFrame, first, last, ts=None, group: list[str] | None = None) -> DataFrame:
    """Rows with first <= row_id <= last, latest version per cell as of ts. Filters reach the Parquet scan."""
    return asof(cells.filter(F.col("row_id").between(first, last)), ts, group)


def row_get(cells: DataFrame, row_key: str, ts=None) -> DataFrame:
    """One row, latest cells (as of ts when given; a future ts returns the last values with own ts)."""
    return asof(cells.filter(F.col("row_key") == row_key), ts)


def versions(cells: DataFrame, n: int, group: list[str] | None = None) -> DataFrame:
    """Newest ``n`` versions of each cell with rank 1 = newest. The window holds one cell's versions."""
    w = Window.partitionBy(*(group or []), *CELL_KEY).orderBy(F.col("ts").desc())
    return cells.withColumn("version", F.row_number().over(w)).filter(F.col("version") <= n)


def cap_versions(cells: DataFrame, n: int = MAX_VERSIONS, group: list[str] | None = None) -> DataFrame:
    """K5: the history with at most ``n`` versions per cell (what a version-capped store retains)."""
    return versions(cells, n, group).drop("version")


def _events(cells: DataFrame, tombstones: DataFrame, read_ts, mode: str, group: list[str]) -> DataFrame:
    """Cells and tombstones as one stream (``_dead`` marks a tombstone), all events of a row in one partition: the only
    exchange of a masked read. Reads as of a time see what happened by then; ``literal`` tombstones have always happened."""
    t = tombstones.select(*group, *CELL_KEY, "ts")
    if read_ts is not None:
        cells = cells.filter(F.col("ts") <= F.lit(read_ts))
        t = t.filter(F.col("ts") <= F.lit(read_ts)) if mode == "corrected" else t
    return cells.withColumn("_dead", F.lit(False)).unionByName(t.withColumn("_dead", F.lit(True)), allowMissingColumns=True) \
        .withColumn("_h", key_hash(*group, "row_key")).repartition("_h")


def mask_tombstones(cells: DataFrame, tombstones: DataFrame, read_ts=None, mode: str = "corrected",
                    group: list[str] | None = None) -> DataFrame:
    """K8: every cell version not covered by a tombstone of its cell or of its whole row (column null).

    A tombstone at t covers all versions with ts <= t; later versions survive. ``literal`` applies tombstones
    regardless of the read time (the store behaviour); ``corrected`` only those with ts <= read_ts. Tombstones are events of
    their row, resolved by windows in the rows' own partitioning."""
    group = group or []
    row = Window.partitionBy("_h", *group, "row_key")
    cell = Window.partitionBy("_h", *group, *CELL_KEY)
    dead = F.when(F.col("_dead"), F.col("ts"))
    e = _events(cells, tombstones, read_ts, mode, group)
    e = e.withColumn("_tr", F.max(F.when(F.col("column").isNull(), dead)).over(row)).withColumn("_tc", F.max(dead).over(cell))
    last = F.greatest("_tr", "_tc")  # ignores nulls
    return e.filter(~F.col("_dead") & (last.isNull() | (F.col("ts") > last))).drop("_dead", "_tr", "_tc", "_h")


def masked_states(cells: DataFrame, tombstones: DataFrame, bounds: dict[str, int | None], mode: str = "corrected",
                  group: list[str] | None = None) -> DataFrame:
    """(group…, row_key, column, <name>…): for each bound (None: no bound) the newest version that no tombstone covers, as a
    struct (ts, value, is_null, row_id), null where nothing is visible. A version is visible if it is newer than the newest
    tombstone of its cell and of its row, so one aggregation keyed by the row answers all bounds."""
    group = group or []
    seen = lambda b: F.lit(True) if b is None else F.col("ts") <= F.lit(b)
    past = lambda b: seen(b) if mode == "corrected" else F.lit(True)
    top = max(bounds.values()) if all(b is not None for b in bounds.values()) else None
    v = F.struct("ts", "value", "is_null", "row_id")
    aggs = [x for n, b in bounds.items() for x in (
        F.max(F.when(~F.col("_dead") & seen(b), v)).alias(n), F.max(F.when(F.col("_dead") & past(b), F.col("ts"))).alias(f"_t_{n}"))]
    g = _events(cells, tombstones, top, mode, group).groupBy("_h", *group, *CELL_KEY).agg(*aggs)
    row = Window.partitionBy("_h", *group, "row_key")
    for n in bounds:  # no exchange: the rows' partitioning holds for their cells
        whole = F.max(F.when(F.col("column").isNull(), F.col(f"_t_{n}"))).over(row)
        last = F.greatest(whole, F.col(f"_t_{n}"))
        g = g.withColumn(n, F.when(last.isNull() | (F.col(f"{n}.ts") > last), F.col(n)))
    return g.filter(F.col("column").isNotNull()).select(*group, *CELL_KEY, *bounds)


def masked_asof(cells: DataFrame, tombstones: DataFrame | None, ts=None, mode: str = "corrected",
                group: list[str] | None = None) -> DataFrame:
    """S16 + J8: as-of state after tombstones."""
    if tombstones is None:
        return asof(cells, ts, group)
    g = masked_states(cells, tombstones, {"v": ts}, mode, group).filter(F.col("v").isNotNull())
    return g.select(*(group or []), *CELL_KEY, F.col("v.row_id").alias("row_id"), F.col("v.ts").alias("ts"),
                    F.col("v.value").alias("value"), F.col("v.is_null").alias("is_null"))


def pivot_state(state: DataFrame, columns: list[str], group: list[str] | None = None,
                strip_family: bool = True) -> DataFrame:
    """Cells -> one row per row_key with one column per cell name (known list, so no extra pass)."""
    group = group or []
    aggs = []
    for c in columns:
        name = c.split(":", 1)[1] if (strip_family and ":" in c) else c
        aggs.append(F.max(F.when(F.col("column") == c, F.col("value"))).alias(name))
    return state.groupBy(*group, "row_key").agg(F.max("row_id").alias("row_id"), *aggs)


def asof_wide(cells: DataFrame, columns: list[str], ts=None, group: list[str] | None = None,
              strip_family: bool = True, tombstones: DataFrame | None = None) -> DataFrame:
    """A5 + A11 (+ J8) fused: one row per row_key with the latest value of each cell as of ``ts`` — a single aggregation
    keyed by row_key (one shuffle instead of two); partial aggregation collapses versions map-side. Tombstones (corrected) are
    further events of that aggregation; a row without a visible cell is absent."""
    group = group or []
    if ts is not None:
        cells = cells.filter(F.col("ts") <= (ts if isinstance(ts, Column) else F.lit(ts)))
    names = {c: c.split(":", 1)[1] if (strip_family and ":" in c) else c for c in columns}
    newest = {c: F.max(F.when(F.col("column") == c, F.struct("ts", "value"))) for c in columns}
    by = key_hash(*group, "row_key")
    if tombstones is None:
        return cells.withColumn("_h", by).groupBy("_h", *group, "row_key").agg(
            F.max("row_id").alias("row_id"), *[newest[c]["value"].alias(n) for c, n in names.items()]).drop("_h")
    t = tombstones.select(*group, *CELL_KEY, "ts")
    t = t if ts is None else t.filter(F.col("ts") <= (ts if isinstance(ts, Column) else F.lit(ts)))
    e = cells.withColumn("_dead", F.lit(False)).unionByName(t.withColumn("_dead", F.lit(True)), allowMissingColumns=True)
    own = lambda c: F.col("column").isNull() if c is None else F.col("column") == c
    dead = lambda c: F.max(F.when(F.col("_dead") & own(c), F.col("ts")))
    live = lambda c: F.max(F.when(~F.col("_dead") & own(c), F.struct("ts", "value")))
    others = F.max(F.when(~F.col("_dead") & ~F.col("column").isin(columns), F.col("ts"))) if columns else F.max(F.when(~F.col("_dead"), F.col("ts")))
    g = e.withColumn("_h", by).groupBy("_h", *group, "row_key").agg(
        F.max("row_id").alias("row_id"), dead(None).alias("_row"), others.alias("_other"),
        *[x for i, c in enumerate(columns) for x in (live(c).alias(f"_v{i}"), dead(c).alias(f"_t{i}"))])
    shown = []
    for i in range(len(columns)):
        last = F.greatest("_row", f"_t{i}")
        shown.append(F.col(f"_v{i}").isNotNull() & (last.isNull() | (F.col(f"_v{i}.ts") > last)))
    # cells of columns that are not asked for keep a row alive too
    alive = F.col("_other").isNotNull() & (F.col("_row").isNull() | (F.col("_other") > F.col("_row")))
    for s in shown:
        alive = alive | s
    return g.filter(alive).select(*group, "row_key", "row_id", *[
        F.when(s, F.col(f"_v{i}.value")).alias(n) for i, (s, n) in enumerate(zip(shown, names.values()))])
