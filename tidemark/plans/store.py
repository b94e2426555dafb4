"""Parquet store for staged dumps and published history (K1-K6, K8-K10, L4-L6, publish log, base snapshots).

Layout under ``root`` (a shared folder, e.g. the cluster's object store):
  stage_chunks    namespace, tbl_name, first_stage     chunks by the stage that brought them, sorted by md5
  stage_manifest  namespace, dump_ts, stage_id         one folder per staging run of a dump
  stage_ddl / stage_views / stage_meta                 same
  stage_commits   one row per finished staging run, written last: readers see the newest run of each dump, whole or not at all
  history         namespace, tbl_name, publish_id      clustered by row; replaced as a whole if a crashed publish is re-run
  tombstones      same partitioning (only with apply_deletes)
  publish_log     namespace, tbl_name                  one row per finished publish, written last: readers see what it names
  bases           namespace, tbl_name, base_id         the state as of a time: a read takes one base and what it lacks
  base_log        namespace, tbl_name                  one row per finished base, written last

Each commit row is one file, and nothing that a reader may be looking at is rewritten. One writer at a time per namespace
(staging) and per table (publishing).
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import round1
from tidemark.operators import history as H
from tidemark.operators.cells import bounded_broadcast
from tidemark.plans import publish as P
from tidemark.plans.stage import StagedDump, new_chunks_to_store
from tidemark.session import checkpointed

CELL = "row_key string, row_id bigint, column string, ts bigint, value string, is_null boolean"
SCHEMAS = {
    "stage_chunks": "md5 string, payload string, namespace string, tbl_name string, first_stage string",
    "stage_manifest": "tbl_name string, seq bigint, md5 string, first_stage string, namespace string, dump_ts bigint, stage_id string",
    "stage_ddl": "name string, stmt string, namespace string, dump_ts bigint, stage_id string",
    "stage_views": "name string, stmt string, namespace string, dump_ts bigint, stage_id string",
    "stage_meta": "status string, rowcount bigint, md5 string, parsetime double, namespace string, dump_ts bigint, stage_id string",
    "stage_commits": "namespace string, dump_ts bigint, stage_id string, committed bigint",
    "history": f"{CELL}, namespace string, tbl_name string, publish_id bigint",
    "tombstones": "row_key string, column string, ts bigint, namespace string, tbl_name string, publish_id bigint",
    "publish_log": "dump_ts bigint, next_ts bigint, mode string, deletes boolean, committed bigint, namespace string, tbl_name string",
    "bases": f"{CELL}, namespace string, tbl_name string, base_id string",
    "base_log": "base_id string, base_ts bigint, included array<bigint>, namespace string, tbl_name string",
}

PARTS = {
    "stage_chunks": ["namespace", "tbl_name", "first_stage"],
    "stage_manifest": ["namespace", "dump_ts", "stage_id"],
    "stage_ddl": ["namespace", "dump_ts", "stage_id"],
    "stage_views": ["namespace", "dump_ts", "stage_id"],
    "stage_meta": ["namespace", "dump_ts", "stage_id"],
    "stage_commits": [],
    "history": ["namespace", "tbl_name", "publish_id"],
    "tombstones": ["namespace", "tbl_name", "publish_id"],
    "publish_log": ["namespace", "tbl_name"],
    "bases": ["namespace", "tbl_name", "base_id"],
    "base_log": ["namespace", "tbl_name"],
}
PER_DUMP = ("stage_manifest", "stage_ddl", "stage_views", "stage_meta")
FILE_ROWS = 4_000_000  # rows of one clustered file
ROW_GROUP = 16 << 20  # bytes of a row group of clustered files, the unit that a read of a row range can skip


@dataclass
class AsOf:
    """What a read as of a time touches: cells of one base (if any) and of the publishes it lacks, and tombstones."""

    cells: DataFrame
    tombstones: DataFrame | None
    base: Row | None
    increments: list[int]


def clustered(df: DataFrame, parts: list[str], file_rows: int = FILE_ROWS, lead: list[str] | None = None) -> DataFrame:
    """Rows ranged over files by row and sorted inside, so that a file and its row groups hold a narrow row range.

    ``df`` is materialised; counting it is cheap. Partition columns lead the sort: the writer then keeps the order."""
    files = max(1, -(-df.count() // file_rows))
    return df.repartitionByRange(files, *(lead or []), "row_id", "row_key").sortWithinPartitions(*parts, "row_id", "row_key", "column", "ts")


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ---------------------------------------------------------------- files
    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _fs(self, path: str):
        """(Hadoop file system, path); a path without a scheme belongs to the default one, as for Spark's writers."""
        sc = self.spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(sc._jsc.hadoopConfiguration()), p

    def exists(self, name: str) -> bool:
        fs, p = self._fs(self.path(name))
        return fs.exists(p)

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        if fs.exists(p):
            fs.delete(p, True)

    def _folders(self, name: str, depth: int) -> list[str]:
        fs, p = self._fs(self.path(name))
        found = fs.globStatus(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name) + "/*=*" * depth)) or []
        return [str(x.getPath().toString()) for x in found]

    def raw(self, name: str) -> DataFrame | None:
        """The table with its declared schema, committed or not (an empty folder reads as empty); None if absent."""
        if not self.exists(name):
            return None
        return self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name))

    def _write(self, df: DataFrame, name: str, mode: str = "append") -> None:
        w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("parquet.block.size", str(ROW_GROUP))
        if PARTS[name]:
            w = w.partitionBy(*PARTS[name])
        w.parquet(self.path(name))

    def _commit(self, name: str, rows: list[tuple]) -> None:
        self._write(self.spark.createDataFrame(rows, SCHEMAS[name]).coalesce(1), name)

    # ---------------------------------------------------------------- staging
    def commits(self) -> list[Row]:
        """Finished staging runs, oldest first (one row per run: metadata)."""
        c = self.raw("stage_commits")
        return [] if c is None else sorted(c.collect(), key=lambda r: r["committed"])

    def read(self, name: str) -> DataFrame | None:
        """A table as its commits state it: per-dump tables hold each dump's newest finished run, chunks those of finished
        runs, history and tombstones those of logged publishes. None if absent."""
        df = self.raw(name)
        if df is None:
            return None
        if name in PER_DUMP:
            newest = {(r["namespace"], r["dump_ts"]): r["stage_id"] for r in self.commits()}
            return df.filter(F.col("stage_id").isin(list(newest.values())) if newest else F.lit(False))
        if name == "stage_chunks":
            runs = sorted({r["stage_id"] for r in self.commits()})
            return df.filter(F.col("first_stage").isin(runs) if runs else F.lit(False))
        if name in ("history", "tombstones"):
            log = self.raw("publish_log")
            if log is None:
                return df.limit(0)
            done = log.select("namespace", "tbl_name", F.col("dump_ts").alias("publish_id")).distinct()
            return df.join(bounded_broadcast(done, 1_000_000), ["namespace", "tbl_name", "publish_id"], "left_semi")
        return df

    def stage(self, staged: StagedDump, dry_run: bool = False) -> StagedDump:
        """K1 + K2. Everything of a run goes to folders of its own; the commit row, written last, makes it visible and
        replaces an earlier run of the same dump as a whole. A crash leaves only folders that ``vacuum`` removes."""
        if dry_run:
            return staged
        t0 = time.time()
        run = f"{time.time_ns() // 1000:x}-{uuid.uuid4().hex[:8]}"
        key = ["namespace", "tbl_name", "md5"]
        known = self.read("stage_chunks")
        new = new_chunks_to_store(staged.chunks, known, keys=staged.manifest, picks=staged.picks).withColumn("first_stage", F.lit(run))
        cols = [*key, "payload", "first_stage"]
        self._write(new.select(*cols).sortWithinPartitions("namespace", "tbl_name", "first_stage", "md5"), "stage_chunks")
        manifest = staged.manifest
        if known is not None:  # the partition that holds each chunk
            held = known.select(*key, F.col("first_stage").alias("_held")).dropDuplicates(key)
            manifest = manifest.join(held, key, "left")
        else:
            manifest = manifest.withColumn("_held", F.lit(None).cast("string"))
        self._write(manifest.withColumn("first_stage", F.coalesce("_held", F.lit(run))).drop("_held").withColumn("stage_id", F.lit(run)),
                    "stage_manifest")
        for name, df in [("stage_ddl", staged.ddl), ("stage_views", staged.views)]:
            self._write(df.withColumn("stage_id", F.lit(run)), name)
        # Seconds spent staging, one decimal
        meta = checkpointed(staged.meta.withColumn("parsetime", round1(F.lit(time.time() - t0))).withColumn("stage_id", F.lit(run)))
        self._write(meta, "stage_meta")
        now = time.time_ns() // 1000
        dumps = meta.select("namespace", "dump_ts").distinct().collect()  # the dumps of this run
        self._commit("stage_commits", [(d["namespace"], d["dump_ts"], run, now) for d in dumps])
        return staged

    def vacuum(self) -> int:
        """Remove folders of staging runs that never finished or were replaced, chunks that no finished run brought, and
        bases and publishes without a log row. Not while another process writes. Returns the number of folders removed."""
        runs = self.commits()
        newest = set({(r["namespace"], r["dump_ts"]): r["stage_id"] for r in runs}.values())
        ever = {r["stage_id"] for r in runs}
        part = lambda path: path.rsplit("=", 1)[1]
        doomed = [f for n in PER_DUMP for f in self._folders(n, 3) if part(f) not in newest]
        doomed += [f for f in self._folders("stage_chunks", 3) if part(f) not in ever]
        for name, log, col in (("history", "publish_log", "dump_ts"), ("tombstones", "publish_log", "dump_ts"), ("bases", "base_log", "base_id")):
            rows = self.raw(log)
            keep = set() if rows is None else {(r["namespace"], r["tbl_name"], str(r[col])) for r in rows.select("namespace", "tbl_name", col).collect()}
            doomed += [f for f in self._folders(name, 3) if tuple(x.split("=", 1)[1] for x in f.split("/")[-3:]) not in keep]
        for f in doomed:
            self._delete(f)
        return len(doomed)

    def staged(self) -> P.Staged:
        return P.Staged(self.read("stage_manifest"), self.read("stage_chunks"), self.read("stage_ddl"),
                        self.read("stage_views"))

    def chunk(self, namespace: str, tbl: str, md5: str) -> DataFrame:
        """One chunk by its hash: (md5, payload). The manifest names its partition, md5 statistics the row groups."""
        mine = (F.col("namespace") == namespace) & (F.col("tbl_name") == tbl) & (F.col("md5") == md5)
        stages = [r[0] for r in self.read("stage_manifest").filter(mine).select("first_stage").distinct().collect()]
        return self.raw("stage_chunks").filter(mine & F.col("first_stage").isin(stages)).select("md5", "payload")

    # ---------------------------------------------------------------- publishing
    def _of(self, df: DataFrame | None, namespace: str, tbl: str) -> DataFrame | None:
        return None if df is None else df.filter((F.col("namespace") == namespace) & (F.col("tbl_name") == tbl))

    def log(self, namespace: str, tbl: str) -> list[Row]:
        """Finished publishes of a table in the order they were made (metadata)."""
        log = self._of(self.raw("publish_log"), namespace, tbl)
        return [] if log is None else sorted(log.collect(), key=lambda r: r["committed"])

    def published(self, namespace: str, tbl: str) -> list[int]:
        return list(dict.fromkeys(r["dump_ts"] for r in self.log(namespace, tbl)))

    def history(self, namespace: str | None = None, tbl: str | None = None) -> DataFrame:
        """Cells of finished publishes, of all tables or of one."""
        if tbl is not None:
            return self._at(self.raw("history"), namespace, tbl, self.published(namespace, tbl))
        h = self.read("history")
        return h if h is not None else self.spark.createDataFrame([], SCHEMAS["history"])

    def _at(self, df: DataFrame | None, namespace: str, tbl: str, ids: list[int], name: str = "history") -> DataFrame:
        """Rows of some publishes of a table: filters on partition values, known before the scan."""
        df = self._of(df, namespace, tbl)
        if df is None:
            return self.spark.createDataFrame([], SCHEMAS[name])
        return df.filter(F.col("publish_id").isin(ids) if ids else F.lit(False))

    def tombstones(self, namespace: str | None = None, tbl: str | None = None) -> DataFrame | None:
        if tbl is not None and self.exists("tombstones"):
            return self._at(self.raw("tombstones"), namespace, tbl, self.published(namespace, tbl), "tombstones")
        return self.read("tombstones")

    def asof(self, namespace: str, tbl: str, ts: int | None = None, base_by: int | None = None) -> AsOf:
        """What a read as of ``ts`` needs: the newest base at or before ``base_by`` (default ``ts``) and the publishes it
        lacks.

        A base holds, for every cell visible as of its time, the version visible then. Every other version that counts is in
        a publish made since (also of an older dump: its cells and tombstones keep their own times, so the newest of
        them and of the base's still wins), or is a repair that a publish wrote for a later dump than the base."""
        log = [r for r in self.log(namespace, tbl) if ts is None or r["dump_ts"] <= ts]  # cells never precede their publish
        by = ts if base_by is None else base_by
        ids = {r["dump_ts"] for r in log}
        bases = self._of(self.raw("base_log"), namespace, tbl)
        usable = [] if bases is None else [b for b in bases.collect() if (by is None or b["base_ts"] <= by) and set(b["included"]) <= ids]
        base = max(usable, key=lambda b: (b["base_ts"], len(b["included"])), default=None)
        if base is None:
            every = sorted(ids)
            t = self._at(self.raw("tombstones"), namespace, tbl, every, "tombstones") if any(r["deletes"] for r in log) else None
            return AsOf(self._at(self.raw("history"), namespace, tbl, every), t, None, every)
        old = set(base["included"])
        since = sorted(ids - old)
        later = sorted({r["dump_ts"] for r in log if r["dump_ts"] in old and r["next_ts"] is not None and r["next_ts"] > base["base_ts"]})

        def lacking(name: str) -> DataFrame:
            raw = self.raw(name)
            out = self._at(raw, namespace, tbl, since, name)
            return out.unionByName(self._at(raw, namespace, tbl, later, name).filter(F.col("ts") > base["base_ts"])) if later else out

        cols = P.HISTORY_COLS
        cells = self._of(self.raw("bases"), namespace, tbl).filter(F.col("base_id") == base["base_id"]).select(*cols)
        if since or later:
            cells = cells.unionByName(lacking("history").select(*cols))
        t = lacking("tombstones") if any(r["deletes"] for r in log if r["dump_ts"] in {*since, *later}) else None
        return AsOf(cells, t, base, sorted({*since, *later}))

    def build_base(self, namespace: str, tbl: str, ts: int) -> Row:
        """Write the state as of ``ts`` as a base, from the base before it and what that lacks. Reads as of any time stay as
        they are, only cheaper from ``ts`` on."""
        at = self.asof(namespace, tbl, ts)
        base_id = f"{time.time_ns() // 1000:x}-{uuid.uuid4().hex[:8]}"
        state = H.masked_asof(at.cells, at.tombstones, ts).select(*P.HISTORY_COLS)
        state = checkpointed(state.select("*", F.lit(namespace).alias("namespace"), F.lit(tbl).alias("tbl_name"), F.lit(base_id).alias("base_id")))
        self._write(clustered(state, PARTS["bases"]), "bases")
        included = sorted({d for d in self.published(namespace, tbl) if d <= ts})
        self._commit("base_log", [(base_id, int(ts), included, namespace, tbl)])
        return Row(base_id=base_id, base_ts=int(ts), included=included)

    def drop_bases(self, namespace: str, tbl: str) -> None:
        for name in ("base_log", "bases"):
            self._delete(f"{self.path(name)}/namespace={namespace}/tbl_name={tbl}")

    def _put(self, cells: DataFrame, name: str, namespace: str, tbl: str) -> None:
        """Replace the partition of one publish by materialised rows."""
        tagged = checkpointed(cells.select("*", F.lit(namespace).alias("namespace"), F.lit(tbl).alias("tbl_name")))
        if name == "history":
            tagged = clustered(tagged, PARTS[name])
        self._write(tagged, name, "overwrite")

    def publish(self, namespace: str, tbl: str, when: int, mode: str = "corrected", force: bool = False,
                dry_run: bool = False, apply_deletes: bool = False) -> P.StepResult:
        """L3/L4: publish one table of one dump. A dump already in the log is a no-op; with ``force`` the table is
        rebuilt from its published dumps in the mode it has, since one step can't be redone under the steps after it."""
        log = self.log(namespace, tbl)
        done = self.published(namespace, tbl)
        if when in done and not force:
            return P.StepResult(when, "unchanged")
        if when in done and not dry_run:
            self.rebuild(namespace, tbl, done)
            return P.StepResult(when, "rebuilt")
        if mode == "literal":
            hist, tombs = self.history(namespace, tbl), None
        else:  # the states before the dump and at the next published one come from one base and what it lacks
            nxt = min((d for d in done if d > when), default=None)
            at = self.asof(namespace, tbl, when - 1 if nxt is None else nxt, when - 1)
            hist, tombs = at.cells, at.tombstones
        r = P.publish_step(self.staged(), hist.select(*P.HISTORY_COLS), done, namespace, tbl, when, mode, apply_deletes=apply_deletes,
                           tombstones=None if tombs is None else tombs.select("row_key", "column", "ts"))
        if r.status != "published" or dry_run:
            return r
        self._put(r.cells, "history", namespace, tbl)  # replaces only partition publish_id = when
        if r.tombstones is not None:
            self._put(r.new_tombstones, "tombstones", namespace, tbl)
        deletes = r.tombstones is not None or any(x["deletes"] for x in log if x["dump_ts"] == when)
        self._commit("publish_log", [(int(when), r.next_ts if mode == "corrected" else None, mode, deletes, time.time_ns() // 1000, namespace, tbl)])
        return r

    def put(self, namespace: str, tbl: str, cells: DataFrame, ts: int) -> None:
        """K9: put cells (row_key, row_id, column, value, is_null) at a time of their own, outside any dump."""
        if ts in self.published(namespace, tbl):
            raise ValueError(f"{namespace}.{tbl} has a publish at {ts}")
        rows = cells.select("row_key", "row_id", "column", F.lit(int(ts)).alias("ts"), "value", "is_null", F.lit(int(ts)).alias("publish_id"))
        self._put(rows, "history", namespace, tbl)
        self._commit("publish_log", [(int(ts), None, "put", False, time.time_ns() // 1000, namespace, tbl)])

    def drop(self, namespace: str, tbl: str) -> None:
        """K6: drop a published table. Its log goes first, so a crash in between leaves nothing visible; other tables'
        folders are not touched."""
        for name in ("publish_log", "base_log", "history", "tombstones", "bases"):
            self._delete(f"{self.path(name)}/namespace={namespace}/tbl_name={tbl}")

    def rebuild(self, namespace: str, tbl: str, only: list[int] | None = None) -> DataFrame:
        """L8 into the store: the table from all staged dumps (or of ``only``) in the mode it was published in: one pass for
        corrected tables, with deletes if they were applied; literal tables dump by dump in the order of their log."""
        from tidemark.plans.rebuild import rebuild_history, rebuild_with_deletes
        staged = self.staged()
        log = self.log(namespace, tbl)
        if only is not None:
            staged.manifest = staged.manifest.filter(F.col("dump_ts").isin(only))
        dumps = sorted(int(r[0]) for r in staged.manifest.filter(
            (F.col("namespace") == namespace) & (F.col("tbl_name") == tbl)).select("dump_ts").distinct().collect())
        defs = {d: P.table_def(staged, namespace, tbl, d) for d in dumps}
        cols = {d: [c for c, _ in defs[d][0]] for d in dumps}
        key = defs[dumps[-1]][1]
        mine = lambda df: checkpointed(df.select("*", F.lit(namespace).alias("namespace"), F.lit(tbl).alias("tbl_name")))
        literal = any(r["mode"] == "literal" for r in log)
        deletes = any(r["deletes"] for r in log)
        t = None
        if literal:
            order = [r["dump_ts"] for r in log if r["dump_ts"] in dumps] + [d for d in dumps if d not in {r["dump_ts"] for r in log}]
            h = mine(P.publish_sequence(self.spark, self.staged(), namespace, tbl, order, mode="literal")[0])
        elif deletes:  # the table was published with its deletes applied: keep them
            h, t = (mine(x) for x in rebuild_with_deletes(staged, namespace, tbl, cols, key=key))
        else:
            h = mine(rebuild_history(staged, namespace, tbl, cols, key=key))
        self.drop(namespace, tbl)
        self._write(clustered(h, PARTS["history"]), "history", "overwrite")
        if t is not None:
            self._write(t, "tombstones", "overwrite")
        now = time.time_ns() // 1000
        nexts = dict(zip(dumps, [*dumps[1:], None]))
        self._commit("publish_log", [(d, nexts[d], "literal" if literal else "corrected", deletes, now + i, namespace, tbl) for i, d in enumerate(dumps)])
        return h

    def read_asof(self, namespace: str, tbl: str, ts: int | None = None, dump_for_schema: int | None = None):
        """The published table as of ``ts`` (all of history when None), typed by the DDL of ``dump_for_schema``
        (default: the last dump published by then). Reads one base and the publishes it lacks."""
        from tidemark.plans.read import typed_asof
        log = [r for r in self.log(namespace, tbl) if r["mode"] != "put"]
        if not log:
            raise ValueError(f"{namespace}.{tbl} is not published")
        at = self.asof(namespace, tbl, ts)
        dumps = [r["dump_ts"] for r in log]
        schema_dump = dump_for_schema if dump_for_schema is not None else max((d for d in dumps if ts is None or d <= ts), default=min(dumps))
        cols, key = P.table_def(self.staged(), namespace, tbl, schema_dump)
        literal = any(r["mode"] == "literal" for r in log)
        return typed_asof(at.cells, cols, ts, at.tombstones, key=None if literal else key)

    def row_range(self, namespace: str, tbl: str, first: int, last: int, ts: int | None = None) -> DataFrame:
        """The cells of rows ``first`` to ``last`` as of ``ts``. Files are clustered by row, so the filter on row_id skips
        files and row groups by their statistics."""
        at = self.asof(namespace, tbl, ts)
        cells = at.cells.filter(F.col("row_id").between(first, last))
        t = at.tombstones
        if t is not None:
            t = t.join(cells.select("row_key").distinct(), "row_key", "left_semi")
        return H.masked_asof(cells.select(*P.HISTORY_COLS), t, ts)

    # ---------------------------------------------------------------- namespace-level operations
    def tables_of(self, namespace: str, when: int) -> DataFrame:
        """Tables with a CREATE in dump ``when``."""
        return self.read("stage_ddl").filter((F.col("namespace") == namespace) & (F.col("dump_ts") == when)).select(
            F.col("name").alias("tbl_name")).distinct()

    def publish_namespace(self, namespace: str, when: int, include_file: str | None = None, exclude_file: str | None = None,
                          apply_deletes: bool = False, **kw) -> list[tuple[str, str]]:
        """Publish the selected tables of a dump (include list wins over exclude list). Tables that share their baseline and
        next published dump go through one plan and one write, so the number of jobs doesn't grow with the tables (other
        modes and forced publishes go table by table). Returns (table, status)."""
        from tidemark.plans.catalog import select_tables
        from tidemark.sources.dumpfile import read_list
        inc = read_list(self.spark, include_file) if include_file else None
        exc = read_list(self.spark, exclude_file) if exclude_file else None
        names = sorted(r[0] for r in select_tables(self.tables_of(namespace, when), inc, exc).collect())
        if kw:
            return [(t, self.publish(namespace, t, when, apply_deletes=apply_deletes, **kw).status) for t in names]
        log = self.raw("publish_log")
        done: dict[str, list[Row]] = {t: [] for t in names}
        if log is not None:
            for r in log.filter((F.col("namespace") == namespace) & F.col("tbl_name").isin(names)).collect():
                done[r["tbl_name"]].append(r)
        todo = {t: [r["dump_ts"] for r in rows] for t, rows in done.items() if when not in {r["dump_ts"] for r in rows}}
        status = {t: "published" if t in todo else "unchanged" for t in names}
        if not todo:
            return [(t, status[t]) for t in names]
        committed = [(t, d) for t, ds in todo.items() for d in set(ds)]
        pairs = self.spark.createDataFrame(committed, "tbl_name string, publish_id bigint")

        def visible(name: str) -> DataFrame:
            raw = self.raw(name)
            raw = self.spark.createDataFrame([], SCHEMAS[name]) if raw is None else raw
            return raw.filter((F.col("namespace") == namespace) & F.col("tbl_name").isin(list(todo))).join(
                bounded_broadcast(pairs, 1_000_000), ["tbl_name", "publish_id"], "left_semi")

        deleted = any(r["deletes"] for t in todo for r in done[t])
        ns = F.lit(namespace).alias("namespace")
        for r in P.publish_tables(self.staged(), visible("history"), todo, namespace, when, apply_deletes, visible("tombstones") if deleted else None):
            cells = checkpointed(r.cells.select("*", ns))
            self._write(clustered(cells, PARTS["history"], lead=["tbl_name"]), "history", "overwrite")  # partitions publish_id = when
            if r.new_tombstones is not None:
                self._write(checkpointed(r.new_tombstones.select("*", ns)), "tombstones", "overwrite")
            now = time.time_ns() // 1000
            self._commit("publish_log", [(int(when), r.next_ts, "corrected", apply_deletes, now, namespace, t) for t in r.tables])
        return [(t, status[t]) for t in names]

    def register(self, namespace: str, tbl: str, ts: int | None = None, save_as_table: bool = False) -> str:
        """K7: expose the typed table as ``namespace_tbl`` (temp view, or a catalog table when asked)."""
        name = f"{namespace}_{tbl}"
        df = self.read_asof(namespace, tbl, ts)
        if save_as_table:
            df.write.mode("overwrite").saveAsTable(name)
        else:
            df.createOrReplaceTempView(name)
        return name

    def apply_views(self, namespace: str, when: int):
        """Register the published tables of the dump, then create its staged views over them."""
        from tidemark.plans.read import apply_views
        tables = [t for t in (r[0] for r in self.tables_of(namespace, when).collect())
                  if when in self.published(namespace, t)]
        for t in tables:
            self.register(namespace, t, when)
        views = [(r["name"], r["stmt"]) for r in self.read("stage_views").filter(
            (F.col("namespace") == namespace) & (F.col("dump_ts") == when)).select("name", "stmt").collect()]
        return apply_views(self.spark, views, namespace, tables)

    def compact(self, namespace: str, tbl: str, max_versions: int = H.MAX_VERSIONS) -> DataFrame:
        """K5: keep at most ``max_versions`` versions per cell (what the version-capped store retains); the table's
        history partitions are rewritten (materialised first: a path cannot be overwritten while it is read)."""
        h = self.history(namespace, tbl)
        capped = checkpointed(H.cap_versions(h, max_versions))
        left = {r[0] for r in capped.select("publish_id").distinct().collect()}
        self.drop_bases(namespace, tbl)
        self._write(clustered(capped, PARTS["history"]), "history", "overwrite")  # every publish_id present is replaced
        for d in self.published(namespace, tbl):
            if d not in left:  # partitions left without versions
                self._delete(f"{self.path('history')}/namespace={namespace}/tbl_name={tbl}/publish_id={d}")
        return capped
