"""Publishing staged dumps into a versioned cell history.

``publish_step`` is a pure DataFrame function: staged frames + current history -> the cells to add. Nothing passes
through the driver except metadata (the table's column list, the published dump timestamps).

corrected (default): baseline = latest *published* dump before ``when``; new chunks = its md5 set difference;
  prev state = history as of when-1 for the incoming keys; next = the next published dump; late dumps restore the
  shadowed next values (J13). Publishing is idempotent through the publish log.
literal: baseline/next = neighbouring *staged* milestones (W1/W3); a non-milestone dump is a no-op; prev/next are
  read over each chunk's id range (J2).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.ddl import parse_ddl, with_types
from tidemark.functions.keys import Key, key_of
from tidemark.functions.scalars import key_hash
from tidemark.operators import diff as D
from tidemark.operators import history as H
from tidemark.operators import milestones as M
from tidemark.operators.cells import cell_columns, chunk_id_range, chunk_packed, chunk_rows, last_rows, named, row_keys, unpacked
from tidemark.session import checkpointed

HISTORY_COLS = ["row_key", "row_id", "column", "ts", "value", "is_null"]
# md5 sets of new/removed chunks (32-byte keys) are broadcast to the chunk scan below this count, so payloads are
# filtered where they are read; above it the semi join shuffles (AQE may still pick broadcast at run time).
NEW_CHUNK_BROADCAST_ROWS = 2_000_000
POINT_LOOKUP_KEYS = 200  # so few chunk keys become a filter of the scan, which row group statistics answer
KEY_BROADCAST_ROWS = 1_000_000  # incoming row keys (≤ ~40 B each) broadcast to the history scan below this count


@dataclass
class Staged:
    """Staging tables (Parquet or derived frames)."""
    manifest: DataFrame  # namespace, tbl_name, dump_ts, seq, md5[, first_stage]
    chunks: DataFrame    # namespace, tbl_name, md5, payload[, first_stage: partition that holds the chunk]
    ddl: DataFrame       # namespace, dump_ts, name, stmt
    views: DataFrame | None = None  # namespace, dump_ts, name, stmt
    columns: dict = field(default_factory=dict, repr=False)  # column lists read so far

    def table(self, namespace: str, tbl: str) -> "Staged":
        f = (F.col("namespace") == namespace) & (F.col("tbl_name") == tbl)
        return Staged(self.manifest.filter(f), self.chunks.filter(f), self.ddl, self.views)


@dataclass
class StepResult:
    when: int
    status: str                  # published | unchanged | schema_only
    diff: D.Diff | None = None
    baseline: int | None = None
    next_ts: int | None = None
    columns: list[str] = field(default_factory=list)
    tombstones: DataFrame | None = None  # apply_deletes: (row_key, column|null, ts) to add, publish_id = when
    duplicates: DataFrame | None = None  # (row_key, n_puts) of keys that several rows of the new chunks share
    stored: bool = False  # cells only read what the step has materialised

    @property
    def cells(self) -> DataFrame:
        """History rows to add: writes at when and restores at next (both carry publish_id = when)."""
        w = self.diff.writes.select(*HISTORY_COLS).unionByName(self.diff.restores.select(*HISTORY_COLS))
        return w.withColumn("publish_id", F.lit(self.when).cast("bigint"))

    @property
    def new_tombstones(self) -> DataFrame | None:
        if self.tombstones is None:
            return None
        return self.tombstones.select("row_key", "column", "ts").withColumn("publish_id", F.lit(self.when).cast("bigint"))


def table_schema(staged: Staged, namespace: str, tbl: str, when: int, native: bool = False) -> DataFrame:
    """(pos, column, mysql_type, …, sql_type, mapped) of the table's DDL in dump ``when``."""
    d = staged.ddl.filter((F.col("namespace") == namespace) & (F.col("dump_ts") == when) & (F.col("name") == tbl))
    return with_types(parse_ddl(d.select(F.col("stmt").alias("payload")), "payload", keep=[]), native)


def table_columns(staged: Staged, namespace: str, tbl: str, when: int) -> list[tuple[str, str]]:
    """Driver-side (column, sql_type) list — DDL metadata, at most a few thousand entries (kept in ``staged``)."""
    return table_def(staged, namespace, tbl, when)[0]


def table_key(staged: Staged, namespace: str, tbl: str, when: int) -> Key | None:
    """PRIMARY KEY of the table in dump ``when``; None without one (then the first column is the key)."""
    return table_def(staged, namespace, tbl, when)[1]


def table_def(staged: Staged, namespace: str, tbl: str, when: int) -> tuple[list[tuple[str, str]], Key | None]:
    at = (namespace, tbl, int(when))
    if at not in staged.columns:
        rows = table_schema(staged, namespace, tbl, when).select("pos", "column", "sql_type", "mysql_type", "scale", "key_pos").collect()
        if not rows:
            raise ValueError(f"no CREATE statement for {namespace}.{tbl} in dump {when}")
        staged.columns[at] = ([(r["column"], r["sql_type"]) for r in sorted(rows, key=lambda r: r["pos"])], key_of(rows))
    return staged.columns[at]


def _keys_of(chunks: DataFrame, columns: list[str] | None = None, key: Key | None = None,
             keep: list[str] | None = None) -> DataFrame:
    keep = keep or ["md5"]
    return row_keys(chunk_rows(chunks.select(*keep, "payload"), keep=keep), columns, key, keep)


def _wanted(chunks: DataFrame, keys: DataFrame) -> tuple[DataFrame, int]:
    """Chunks of ``keys`` (md5[, first_stage], seq) with their seq, and how many keys there are.

    Staged chunks lie in one partition per stage that brought them, sorted by md5; the manifest says which, so only those
    partitions are read (a filter on partition values known before the scan), and within their files the row groups
    whose md5 range holds a wanted key. Keys are broadcast up to a checked count."""
    on = [c for c in ("tbl_name", "md5", "first_stage") if c in chunks.columns and c in keys.columns]
    chunks = chunks.select(*dict.fromkeys(["tbl_name", "md5", *on, "payload"]))
    if "first_stage" in on:
        few = keys.select("md5", "first_stage").limit(POINT_LOOKUP_KEYS + 1).collect()
        n, stages = len(few), sorted({r[1] for r in few})
        if n > POINT_LOOKUP_KEYS:  # one value per stage that first brought a wanted chunk
            n, stages = keys.agg(F.count(F.lit(1)), F.collect_set("first_stage")).first()
        elif n:
            chunks = chunks.filter(F.col("md5").isin([r[0] for r in few]))
        chunks = chunks.filter(F.col("first_stage").isin(stages) if stages else F.lit(False))
    else:
        n = keys.limit(NEW_CHUNK_BROADCAST_ROWS + 1).count()
    right = keys.select(*on, "seq")
    return chunks.join(F.broadcast(right) if n <= NEW_CHUNK_BROADCAST_ROWS else right, on), n


def _dual_state(h: DataFrame, prev_bound: int, next_bound: int | None, materialize: bool = False,
                tomb: DataFrame | None = None):
    """prev and next state from ONE aggregation over the history slice (one shuffle for both reads); with tombstones each
    read only sees versions not covered by a tombstone issued by its own bound.
    ``materialize`` checkpoints that aggregation once: every branch of the diff then reads it."""
    bounds = {"p": prev_bound} | ({} if next_bound is None else {"n": next_bound})
    if tomb is not None:
        g = H.masked_states(h, tomb, bounds)
    else:
        v = F.struct("ts", "value", "is_null", "row_id")
        g = h.withColumn("_h", key_hash(*D.KEY)).groupBy(*D.HASHED).agg(
            *[F.max(F.when(F.col("ts") <= b, v)).alias(n) for n, b in bounds.items()])
    if materialize:
        g = checkpointed(g)
        if g.isEmpty():  # as before a first publish: the diff's joins with it are left out
            g = g.limit(0)

    def side(a):
        return g.filter(F.col(a).isNotNull()).select(
            *[c for c in D.HASHED if c in g.columns], F.col(f"{a}.row_id").alias("row_id"), F.col(f"{a}.ts").alias("ts"),
            F.col(f"{a}.value").alias("value"), F.col(f"{a}.is_null").alias("is_null"))
    return side("p"), (side("n") if next_bound is not None else None)


def _delete_effects(d: D.Diff, nxt: DataFrame | None, tomb: DataFrame | None, when: int, next_ts: int | None):
    """apply_deletes: row tombstones at ``when``; at the next published dump, restore the cells of deleted rows that
    still live there and tombstone late writes of cells that are absent there (unless already covered)."""
    t_when = d.deletes.select("row_key", F.lit(None).cast("string").alias("column"),
                              F.lit(when).cast("bigint").alias("ts"))
    if nxt is None or next_ts is None:
        return t_when, None
    gone = d.deletes.select("row_key").distinct()
    rest = nxt.join(gone, "row_key", "left_semi").filter(F.col("ts") < when).select(
        F.lit(next_ts).cast("bigint").alias("ts"), "row_key", "row_id", "column", "value", "is_null")
    absent = d.writes.select("row_key", "column").join(nxt.select("row_key", "column"), ["row_key", "column"],
                                                        "left_anti")
    if tomb is not None:
        cover = tomb.filter((F.col("ts") >= when) & (F.col("ts") <= next_ts))
        absent = absent.join(cover.filter(F.col("column").isNull()).select("row_key").distinct(), "row_key",
                             "left_anti").join(cover.filter(F.col("column").isNotNull()).select("row_key", "column")
                                               .distinct(), ["row_key", "column"], "left_anti")
    t_next = absent.select("row_key", "column", F.lit(next_ts).cast("bigint").alias("ts"))
    return t_when.unionByName(t_next), rest


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    """No rows, and known to be none by the planner, which leaves out the steps on them."""
    return spark.createDataFrame([], schema).limit(0)


def _no_change_diff(removed_keys: DataFrame | None, when: int) -> D.Diff:
    """Diff of a dump without new chunks: nothing to write; rows of removed chunks are the delete report."""
    spark = SparkSession.getActiveSession()
    cells = _empty(spark, "md5 string, row_key string, row_id bigint, column string, value string, is_null boolean")
    ts = F.lit(None).cast("bigint").alias("ts")
    null_col = F.lit(None).cast("string").alias("column")
    if removed_keys is not None:
        deletes = removed_keys.select(F.lit(when).cast("bigint").alias("ts"), "md5", "row_key", "row_id", null_col)
    else:
        deletes = cells.select(ts, "md5", "row_key", "row_id", null_col)
    return D.Diff(
        writes=cells.select(ts, "row_key", "row_id", "column", "value", "is_null"),
        deletes=deletes,
        redundant=cells.select(ts, "md5", "row_key", "row_id", "column"),
        restores=cells.select(ts, "row_key", "row_id", "column", "value", "is_null"),
        changed=cells,
        identical_next=cells.select("row_key", "row_id", "column", "value", "is_null",
                                    F.lit(None).cast("bigint").alias("n_ts")),
        full_rows=cells.select("row_key", "row_id"))


def _single_puts(rows: DataFrame, materialize: bool) -> tuple[DataFrame, DataFrame]:
    """(rows, duplicates): packed rows of a dump that share a key count by their last put, and the keys are reported (row_key,
    n_puts). A PRIMARY KEY allows none, so they are looked for on keys alone first. Rows without a key share none."""
    ends = [f(c).alias(f"{n}_{c}") for c in ("seq", "tuple_pos") for f, n in ((F.min, "lo"), (F.max, "hi"))]
    shared = "lo_seq < hi_seq or lo_tuple_pos < hi_tuple_pos"
    if materialize:
        twice = rows.groupBy("row_key").agg(*ends).filter(shared).select("row_key")
        if twice.isEmpty():
            return rows.drop("seq", "tuple_pos"), twice.limit(0).select("row_key", F.lit(0).cast("bigint").alias("n_puts"))
    puts = rows.filter(F.col("row_key").isNotNull()).select("row_key", "seq", "tuple_pos").repartition("row_key").groupBy("row_key").agg(
        *ends, F.count_distinct("seq", "tuple_pos").alias("n_puts")).filter(shared).select("row_key", "n_puts")
    own = F.when(F.col("row_key").isNull(), F.struct("md5", "seq", "tuple_pos"))
    last = last_rows(rows.withColumn("_own", own), ["_own"]).drop("_own")
    return checkpointed(last) if materialize else last, puts


def _compared(rows: DataFrame, removed_keys: DataFrame | None, hist: DataFrame, tomb: DataFrame | None, when: int,
              next_ts: int | None, apply_deletes: bool, materialize: bool, names: list[str] | None = None,
              literal_nulls: bool = False) -> StepResult:
    """Corrected publish of incoming packed rows (with seq and tuple_pos) and removed keys against the history of the same rows."""
    rows, duplicates = _single_puts(rows, materialize)
    inc = unpacked(rows, names, literal_nulls)
    keys = rows.select("row_key")
    if apply_deletes and removed_keys is not None:
        keys = keys.unionByName(removed_keys.select("row_key"))
    # the changed keys of an incremental dump are usually few: broadcast them (size-checked) so the history is filtered where
    # it is scanned. Beyond that the history meets the incoming cells in the diff: a semi join would only shuffle it once more
    few = (keys.count() if materialize else keys.limit(KEY_BROADCAST_ROWS + 1).count()) <= KEY_BROADCAST_ROWS
    tk = tomb if apply_deletes else None
    hk = hist
    if few:
        keys = F.broadcast(checkpointed(keys.distinct()) if materialize else keys.distinct())
        hk = hist.join(keys, "row_key", "left_semi")
        tk = None if tk is None else tk.join(keys, "row_key", "left_semi")
    if tk is not None and tk.isEmpty():
        tk = None
    prev, nxt = _dual_state(hk, when - 1, next_ts, materialize and next_ts is not None, tk)  # without a next dump read once
    d = D.diff(inc, prev, nxt, when, next_ts, "corrected", removed_keys=removed_keys, materialize=materialize)
    res = StepResult(when, "published", d, None, next_ts, duplicates=duplicates, stored=materialize and next_ts is None)
    if apply_deletes:
        res.tombstones, rest = _delete_effects(d, nxt, tk, when, next_ts)
        if rest is not None:
            d.restores = d.restores.unionByName(rest.select(*d.restores.columns))
    return res


def table_defs(staged: Staged, namespace: str, tables: list[str], when: int) -> None:
    """Read the DDL of many tables of a dump in one job (kept in ``staged`` for ``table_def``)."""
    d = staged.ddl.filter((F.col("namespace") == namespace) & (F.col("dump_ts") == when) & F.col("name").isin(tables))
    rows = with_types(parse_ddl(d.select("name", F.col("stmt").alias("payload")), "payload", keep=["name"])).select(
        "name", "pos", "column", "sql_type", "mysql_type", "scale", "key_pos").collect()
    for t in tables:
        own = [r for r in rows if r["name"] == t]
        if own:
            staged.columns[namespace, t, int(when)] = ([(r["column"], r["sql_type"]) for r in sorted(own, key=lambda r: r["pos"])], key_of(own))


TABLE_END = "\x00"  # ends the table's name before a row key in a plan over many tables


@dataclass
class ManyResult:
    """One plan over tables that share their baseline and next published dump."""
    tables: list[str]
    next_ts: int | None
    step: StepResult

    @staticmethod
    def _split(df: DataFrame) -> DataFrame:
        name = F.substring_index("row_key", TABLE_END, 1)
        return df.withColumn("tbl_name", name).withColumn("row_key", F.substring("row_key", F.length(name) + 2, F.length("row_key")))

    @property
    def cells(self) -> DataFrame:
        return self._split(self.step.cells)

    @property
    def new_tombstones(self) -> DataFrame | None:
        t = self.step.new_tombstones
        return None if t is None else self._split(t)


def publish_tables(staged: Staged, history: DataFrame, published: dict[str, list[int]], namespace: str, when: int,
                   apply_deletes: bool = False, tombstones: DataFrame | None = None, materialize: bool = True) -> list[ManyResult]:
    """L5 (corrected): publish the tables named by ``published`` (with the dumps each has published) in one plan for each pair
    of baseline and next dump among them, which for tables that are published together is one plan, whatever their number.

    Row keys carry their table's name, so the diff is keyed by (table, row, column). ``history`` and ``tombstones`` have
    tbl_name. Column lists and keys come from the DDL; tables with the same ones are parsed together."""
    tables = sorted(published)
    table_defs(staged, namespace, tables, when)
    groups: dict[tuple[int | None, int | None], list[str]] = {}
    for t in tables:
        others = [p for p in published[t] if p != when]
        groups.setdefault((max((p for p in others if p < when), default=None), min((p for p in others if p > when), default=None)), []).append(t)
    m = staged.manifest.filter(F.col("namespace") == namespace)
    where = ["tbl_name", "md5"] + [c for c in ["first_stage"] if c in m.columns]
    tagged = lambda df: df.withColumn("row_key", F.concat("tbl_name", F.lit(TABLE_END), "row_key")).drop("tbl_name")
    out = []
    for (baseline, next_ts), names in groups.items():
        mine = F.col("tbl_name").isin(names)
        of = lambda ts: m.filter((F.col("dump_ts") == ts) & mine).groupBy(*where).agg(F.max("seq").alias("seq"))  # noqa: E731, B023
        cur, old = of(when), None if baseline is None else of(baseline)
        new = cur if old is None else cur.join(old.select("tbl_name", "md5"), ["tbl_name", "md5"], "left_anti")
        chunks = staged.chunks.filter((F.col("namespace") == namespace) & mine)
        shapes: dict[tuple, list[str]] = {}
        for t in names:
            cols, key = table_def(staged, namespace, t, when)
            shapes.setdefault((tuple(c for c, _ in cols), key), []).append(t)

        def parsed(wanted: DataFrame, parse, keep: list[str]) -> DataFrame:
            each = _wanted(chunks, wanted)[0].select(*keep, "payload")  # noqa: B023
            parts = [parse(each.filter(F.col("tbl_name").isin(ts)), list(cols), key) for (cols, key), ts in shapes.items()]  # noqa: B023
            whole = parts[0]
            for p in parts[1:]:
                whole = whole.unionByName(p)
            return checkpointed(whole) if materialize else whole

        keep = ["tbl_name", "md5", "seq"]
        inc = tagged(parsed(new, lambda c, cols, key: named(chunk_packed(c, cols, keep, key), cell_columns(cols, key)), keep))
        removed = None
        if old is not None:
            gone = old.join(cur.select("tbl_name", "md5"), ["tbl_name", "md5"], "left_anti")
            removed = tagged(parsed(gone, lambda c, cols, key: _keys_of(c, cols, key, ["tbl_name", "md5"]), ["tbl_name", "md5"]))
        rows = lambda df: tagged(df.filter((F.col("namespace") == namespace) & mine & (F.col("publish_id") != when)))  # noqa: E731, B023
        hist = rows(history).select(*HISTORY_COLS)
        tomb = None if tombstones is None else rows(tombstones).select("row_key", "column", "ts")
        step = _compared(inc, removed, hist, tomb, when, next_ts, apply_deletes, materialize)
        step.baseline = baseline
        out.append(ManyResult(names, next_ts, step))
    return out


def publish_step(staged: Staged, history: DataFrame, published: list[int], namespace: str, tbl: str, when: int,
                 mode: str = "corrected", now: int | None = None, literal_nulls: bool | None = None,
                 schema_only: bool = False, materialize: bool = True, apply_deletes: bool = False,
                 tombstones: DataFrame | None = None) -> StepResult:
    """L3 (L2 is the case of an empty history): the cells publishing dump ``when`` adds to ``history``.

    ``materialize``: the incoming cells (the regex parse of every new chunk, the costliest part) are written once to
    the shared checkpoint folder and reused by the four joins of the diff instead of being re-parsed.
    ``apply_deletes`` (corrected mode): deletes become row tombstones, reads of prev/next honour ``tombstones``
    issued by their bound, and the next published dump is repaired for deleted rows and absent cells (J13)."""
    literal_nulls = (mode == "literal") if literal_nulls is None else literal_nulls
    cols, key = table_def(staged, namespace, tbl, when)
    names = [c for c, _ in cols]
    key = None if mode == "literal" else key  # the original rules know only the first column as key
    if schema_only:
        return StepResult(when, "schema_only", columns=names)
    st = staged.table(namespace, tbl)
    m = st.manifest
    hist = history
    if "namespace" in hist.columns:
        hist = hist.filter((F.col("namespace") == namespace) & (F.col("tbl_name") == tbl))
    if "publish_id" in hist.columns:
        hist = hist.filter(F.col("publish_id") != when)
    pub = sorted(set(int(p) for p in published if int(p) != when))

    if mode == "corrected":
        baseline = max([p for p in pub if p < when], default=None)
        next_ts = min([p for p in pub if p > when], default=None)
        where = ["md5"] + [c for c in ["first_stage"] if c in m.columns]
        of = lambda ts: m.filter(F.col("dump_ts") == ts).groupBy(*where).agg(F.max("seq").alias("seq"))
        cur = of(when)
        if baseline is not None:
            old = of(baseline)
            new = cur.join(old.select("md5"), "md5", "left_anti")
            removed = old.join(cur.select("md5"), "md5", "left_anti")
        else:
            new, removed = cur, None
        new_chunks, n_new = _wanted(st.chunks, new)
        removed_keys = None
        if removed is not None:
            removed_keys = _keys_of(_wanted(st.chunks, removed)[0], names, key)
            if materialize and apply_deletes:  # the deletes, the restores and the tombstones read it: parse once
                removed_keys = checkpointed(removed_keys)
        if n_new == 0 and not apply_deletes:
            return StepResult(when, "published", _no_change_diff(removed_keys, when), baseline, next_ts, names)
        inc = chunk_packed(new_chunks.select("md5", "seq", "payload"), names, ["md5", "seq"], key)
        if materialize:
            inc = checkpointed(inc)
        tk = None
        if apply_deletes and tombstones is not None:
            tk = tombstones
            if "namespace" in tk.columns:
                tk = tk.filter((F.col("namespace") == namespace) & (F.col("tbl_name") == tbl))
            if "publish_id" in tk.columns:
                tk = tk.filter(F.col("publish_id") != when)
        res = _compared(inc, removed_keys, hist, tk, when, next_ts, apply_deletes, materialize, cell_columns(names, key), literal_nulls)
        res.baseline, res.columns = baseline, names
        return res

    # literal: staged milestones and their bounds
    now = now if now is not None else 2**63 - 1  # no bound
    bounds = M.milestone_bounds(m, now).filter(F.col("dump_ts") == when).collect()
    if not bounds:
        return StepResult(when, "unchanged", columns=names)
    prev_ts, next_ts = int(bounds[0]["prev_ts"]), int(bounds[0]["next_ts"])
    new = M.new_chunks(m).filter(F.col("dump_ts") == when).select("md5")
    where = ["md5"] + [c for c in ["first_stage"] if c in m.columns]
    new = m.filter(F.col("dump_ts") == when).groupBy(*where).agg(F.max("seq").alias("seq")).join(new, "md5", "left_semi")
    rows = last_rows(chunk_packed(_wanted(st.chunks, new)[0].select("md5", "seq", "payload"), names, ["md5", "seq"], key))
    if materialize:
        rows = checkpointed(rows)
    ranges = chunk_id_range(rows).select("md5", "first_id", "last_id")
    if materialize:  # read by every sweep and join below
        ranges = checkpointed(ranges)
    hk = D.range_join(ranges, hist).drop("md5", "first_id", "last_id")
    prev, nxt = _dual_state(hk, prev_ts, next_ts, materialize)
    prev_in_chunk = D.range_join(ranges, prev.select("row_key", "row_id").distinct()).select("md5", "row_key", "row_id")
    d = D.diff(unpacked(rows, cell_columns(names, key), literal_nulls), prev, nxt, when, next_ts, "literal", prev_in_chunk=prev_in_chunk, materialize=materialize)
    return StepResult(when, "published", d, prev_ts, next_ts, names)


def empty_history(spark: SparkSession) -> DataFrame:
    return _empty(spark, "row_key string, row_id bigint, column string, ts bigint, value string, is_null boolean, publish_id bigint")


def publish_sequence(spark: SparkSession, staged: Staged, namespace: str, tbl: str, order: list[int],
                     mode: str = "corrected", history: DataFrame | None = None, materialize: bool = True,
                     log: list[int] | None = None) -> tuple[DataFrame, list[StepResult]]:
    """Publish dumps one after another (any order) on an in-memory history; each step's result is checkpointed
    in the shared work folder so lineage stays short. Returns the history and step results."""
    h = history if history is not None else empty_history(spark)
    published = list(log or [])
    results = []
    for when in order:
        if mode == "corrected" and when in published:  # publish log: a published dump is a no-op
            results.append(StepResult(when, "unchanged"))
            continue
        r = publish_step(staged, h, published, namespace, tbl, when, mode)
        results.append(r)
        if r.status == "published":
            # only the step's own cells are materialised; history = union of checkpointed pieces
            h = h.unionByName(checkpointed(r.cells) if materialize and not r.stored else r.cells)
        published.append(when)
    return h, results


def publish_sequence_with_deletes(spark: SparkSession, staged: Staged, namespace: str, tbl: str, order: list[int],
                                  materialize: bool = True):
    """Like ``publish_sequence`` with ``apply_deletes``: returns (history, tombstones, results)."""
    h = empty_history(spark)
    t = _empty(spark, "row_key string, column string, ts bigint, publish_id bigint")
    published, results = [], []
    for when in order:
        if when in published:
            results.append(StepResult(when, "unchanged"))
            continue
        r = publish_step(staged, h, published, namespace, tbl, when, apply_deletes=True, tombstones=t)
        results.append(r)
        h = h.unionByName(checkpointed(r.cells) if materialize and not r.stored else r.cells)
        t = t.unionByName(checkpointed(r.new_tombstones) if materialize else r.new_tombstones)
        published.append(when)
    return h, t, results
