"""Spark side of every registered query: (spark, sf_dir) -> DataFrame, each over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import history as H
from tidemark.oracle import ASOF_T
from tidemark.plans import read as RD
from tidemark.sources import fixtures as FX

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    Q[fn.__name__] = fn
    return fn


@query
def asof_scan(spark, sf):
    """Whole EV table as of ASOF_T."""
    return H.asof(FX.events_cells(spark, sf), ASOF_T).select("row_key", "column", "row_id", "ts", "value", "is_null")


# ------------------------------------------------------------------ ORD: staging, milestones, diff, publish
from tidemark.operators import diff as D  # noqa: E402
from tidemark.operators import milestones as M  # noqa: E402
from tidemark.operators.cells import chunk_cells, chunk_id_range as _chunk_id_range  # noqa: E402
from tidemark.plans.publish import (Staged, publish_sequence, publish_sequence_with_deletes, publish_step,  # noqa: E402
                                    table_def, _wanted)
from tidemark.plans.stage import new_chunks_to_store  # noqa: E402
from tidemark.session import checkpointed  # noqa: E402

NS, TBL = FX.NAMESPACE, FX.ORD_TABLE
NOW = 1000  # 'now' of the milestone bounds: a parameter, so results are reproducible
_MEMO: dict = {}


def _memo(key, spark, sf, build):
    k = (key, id(spark), spark.sparkContext.applicationId, sf)
    if k not in _MEMO:
        _MEMO[k] = build()
    return _MEMO[k]


def ord_staged(spark, sf) -> Staged:
    def build():
        ch = checkpointed(FX.orders_chunks(spark, sf))
        manifest = ch.select("namespace", "tbl_name", "dump_ts", "seq", "md5")
        chunks = checkpointed(new_chunks_to_store(ch.select("namespace", "tbl_name", "md5", "payload"), None))
        ddl = ch.select("namespace", "dump_ts").distinct().select(
            "namespace", "dump_ts", F.lit(FX.ORD_TABLE).alias("name"), F.lit(FX.ORD_DDL).alias("stmt"))
        return Staged(manifest, chunks, ddl)
    return _memo("ord", spark, sf, build)


def ord_late(spark, sf):
    """History after publishing 100 and 500, and the step publishing the late dump 300 (corrected)."""
    def build():
        st = ord_staged(spark, sf)
        h, _ = publish_sequence(spark, st, NS, TBL, [100, 500])
        r = publish_step(st, h, [100, 500], NS, TBL, 300)
        return h, r
    return _memo("late", spark, sf, build)


@query
def milestones(spark, sf):
    """Dumps bringing new chunks."""
    return M.milestones(ord_staged(spark, sf).manifest)


@query
def removed_chunks(spark, sf):
    """Chunks of the preceding dump missing from each dump."""
    return M.removed_chunks(ord_staged(spark, sf).manifest)


@query
def milestone_bounds(spark, sf):
    """previous/next milestone of each milestone, extremes 0 and NOW."""
    return M.milestone_bounds(ord_staged(spark, sf).manifest, NOW)


@query
def manifest_changed(spark, sf):
    """Ordered hash list differs from the preceding dump."""
    return M.manifest_changed(ord_staged(spark, sf).manifest)


@query
def chunks_since_published(spark, sf):
    """Chunks new since the latest published dump (published: 100 and 500)."""
    st = ord_staged(spark, sf)
    log = spark.createDataFrame([(NS, TBL, 100), (NS, TBL, 500)], "namespace string, tbl_name string, dump_ts bigint")
    return M.chunks_since(st.manifest, log)


@query
def manifest_history(spark, sf):
    """Ordered hash list of the table in every dump, as (dump, position, md5) rows."""
    from tidemark.operators.positions import positions
    m = ord_staged(spark, sf).manifest
    return positions(m, ["namespace", "tbl_name", "dump_ts"], "seq", "position").select(
        "namespace", "tbl_name", "dump_ts", "position", "md5")


@query
def chunk_lookup(spark, sf):
    """Manifest joined with the content-addressed chunks."""
    st = ord_staged(spark, sf)
    return st.manifest.join(st.chunks, ["namespace", "tbl_name", "md5"]).select(
        "dump_ts", "seq", "md5", "payload")


@query
def chunk_id_range(spark, sf):
    """A1: first/last id and row count of every distinct chunk."""
    st = ord_staged(spark, sf)
    cells = chunk_cells(st.chunks.select("md5", "payload"), FX.ORD_COLUMNS, keep=["md5"])
    return _chunk_id_range(cells)


@query
def publish_full(spark, sf):
    """L2 / K4: first publish of dump 100 into an empty history."""
    h, _ = publish_sequence(spark, ord_staged(spark, sf), NS, TBL, [100], materialize=False)
    return h


@query
def publish_incremental(spark, sf):
    """L3: publish every dump in order (200 and 400 bring nothing new)."""
    h, _ = publish_sequence(spark, ord_staged(spark, sf), NS, TBL, [100, 200, 300, 400, 500])
    return h


@query
def publish_table(spark, sf):
    """L4 with a late dump: publish 100, 500, then 300 — the final history including restores."""
    h, r = ord_late(spark, sf)
    return h.unionByName(r.cells)


def _chunk_staged(ch, ddl: str, tbl: str) -> Staged:
    ch = checkpointed(ch)
    dumps = ch.select("namespace", "dump_ts").distinct().select("namespace", "dump_ts", F.lit(tbl).alias("name"), F.lit(ddl).alias("stmt"))
    return Staged(ch.select("namespace", "tbl_name", "dump_ts", "seq", "md5"),
                  checkpointed(new_chunks_to_store(ch.select("namespace", "tbl_name", "md5", "payload"), None)), dumps)


def _line_published(spark, sf):
    def build():
        st = _chunk_staged(FX.line_chunks(spark, sf), FX.LINE_DDL, FX.LINE_TABLE)
        return st, *publish_sequence_with_deletes(spark, st, NS, FX.LINE_TABLE, FX.LINE_DUMPS)
    return _memo("line", spark, sf, build)


@query
def published_composite_key(spark, sf):
    """K7 / L6 with a PRIMARY KEY of two columns (neither is the first): the table as of each of its two dumps."""
    st, h, t, _ = _line_published(spark, sf)
    out = None
    for d in FX.LINE_DUMPS:
        cols, key = table_def(st, NS, FX.LINE_TABLE, d)
        r = RD.typed_asof(h, cols, d, t, key=key).withColumn("dump_ts", F.lit(d).cast("bigint"))
        out = r if out is None else out.unionByName(r)
    return out


@query
def duplicate_keys(spark, sf):
    """Keys of dump 100 that several rows share, with the number of puts (the last one wins), in the key encoding."""
    return _line_published(spark, sf)[3][0].duplicates


@query
def published_string_key(spark, sf):
    """K7 with a text PRIMARY KEY: keys that differ only in leading zeros are rows of their own."""
    st = _chunk_staged(FX.code_chunks(spark, sf), FX.CODE_DDL, FX.CODE_TABLE)
    h, _ = publish_sequence(spark, st, NS, FX.CODE_TABLE, [100])
    cols, key = table_def(st, NS, FX.CODE_TABLE, 100)
    return RD.typed_asof(h, cols, 100, key=key)


def _late_diff(spark, sf):
    return ord_late(spark, sf)[1].diff


@query
def diff_changed_cells(spark, sf):
    """Incoming cells of dump 300 that differ from the state as of the previous published dump."""
    return _late_diff(spark, sf).changed.select("row_key", "row_id", "column", "value", "is_null")


@query
def diff_identical_next(spark, sf):
    """Incoming cells identical to the state as of the next published dump."""
    return _late_diff(spark, sf).identical_next


@query
def diff_redundant_future(spark, sf):
    """Future cells/rows (ts > when) identical to incoming ones."""
    return _late_diff(spark, sf).redundant


@query
def diff_deletes(spark, sf):
    """J4 (corrected): rows of removed chunks absent from the dump's new chunks."""
    return _late_diff(spark, sf).deletes


@query
def diff_restore(spark, sf):
    """Dump 600 repeats dump 100, both are published, then the late dump 300: its writes would shadow what 600 kept from
    100, so those values are written again at 600. The restores of the ORD sequence (none there) come with them."""
    st = ord_staged(spark, sf)
    again = st.manifest.filter(F.col("dump_ts") == 100).withColumn("dump_ts", F.lit(600).cast("bigint"))
    ddl = st.ddl.unionByName(st.ddl.filter(F.col("dump_ts") == 100).withColumn("dump_ts", F.lit(600).cast("bigint")))
    st6 = Staged(st.manifest.unionByName(again), st.chunks, ddl)
    h, _ = publish_sequence(spark, st6, NS, TBL, [100, 600])
    return _late_diff(spark, sf).restores.unionByName(publish_step(st6, h, [100, 600], NS, TBL, 300).diff.restores)


@query
def snapshot_diff(spark, sf):
    """Writes, deletes, redundant and restores in one tagged frame."""
    return _late_diff(spark, sf).tagged()


@query
def diff_delete_counts(spark, sf):
    """Delete candidates per timestamp."""
    return D.delete_counts(_late_diff(spark, sf).deletes)


@query
def diff_doomed_lists(spark, sf):
    """Deletes and redundant entries grouped by (ts, chunk) into sorted lists."""
    d = _late_diff(spark, sf)
    doomed = d.deletes.unionByName(d.redundant)
    return D.doomed_lists(doomed)


# ------------------------------------------------------------------ DUMP: text scan, statements, DDL, tuples, staging
import uuid  # noqa: E402

from tidemark.functions import ddl as DDL  # noqa: E402
from tidemark.functions import scalars as SC  # noqa: E402
from tidemark.functions.tuples import token_value  # noqa: E402
from tidemark.operators import statements as S  # noqa: E402
from tidemark.operators.cells import chunk_rows, rows_to_cells as _rows_to_cells  # noqa: E402
from tidemark.plans.stage import stage_dump as _stage_dump  # noqa: E402
from tidemark.session import work_dir  # noqa: E402
from tidemark.sources import dumpfile as DF  # noqa: E402

DUMP_NS = "shopdump"


def dump_lines(spark, sf):
    """DUMP lines with dense line numbers (dump_id, line_no, value), materialised once per session."""
    def build():
        return checkpointed(DF.dense_lines(FX.dump_lines(spark, sf)))  # buckets of few lines spread over all cores
    return _memo("dlines", spark, sf, build)


def dump_classified(spark, sf):
    return S.classify(dump_lines(spark, sf)).withColumn("tbl_name", S.statement_table("value", "kind"))


def dump_staged(spark, sf):
    return _memo("dstaged", spark, sf, lambda: _stage_dump(dump_lines(spark, sf), DUMP_NS))


def dump_schema(spark, sf, native=False):
    st = dump_staged(spark, sf)
    return DDL.with_types(DDL.parse_ddl(st.ddl.select("name", F.col("stmt").alias("payload")), keep=["name"]),
                          native)


def dump_cells(spark, sf):
    """All INSERT chunks of DUMP -> cells, names joined per table (size-checked broadcast of the schema)."""
    st = dump_staged(spark, sf)
    names = dump_schema(spark, sf).groupBy("name").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "column"))), lambda x: x["column"]).alias("names"))
    from tidemark.operators.cells import bounded_broadcast, SCHEMA_BROADCAST_ROWS
    rows = chunk_rows(st.chunks.select("tbl_name", "md5", "payload"), keep=["tbl_name", "md5"])
    rows = rows.join(bounded_broadcast(names.withColumnRenamed("name", "tbl_name"), SCHEMA_BROADCAST_ROWS),
                     "tbl_name")
    return _rows_to_cells(rows, names="names", keep=["tbl_name", "md5", "tuple_pos"])


@query
def scan_dump_lines(spark, sf):
    """DUMP written as ordered part files in the shared work folder, scanned back with exact line numbers."""
    path = f"{work_dir(spark)}/dump-{uuid.uuid4().hex}"
    DF.write_dump(FX.dump_lines(spark, sf), path)
    return DF.scan_dump(spark, path, FX.DUMP_ID).withColumn("dump_id", F.col("dump_id").cast("bigint"))


@query
def classify_lines(spark, sf):
    """Kind of every line."""
    return S.classify(dump_lines(spark, sf)).select("dump_id", "line_no", "kind")


@query
def statement_table_name(spark, sf):
    """table/view name of INSERT, CREATE and VIEW lines."""
    return dump_classified(spark, sf).filter(F.col("kind").isin("insert", "create", "view")).select(
        "line_no", "kind", "tbl_name")


@query
def insert_payload(spark, sf):
    """Tuple list of every INSERT (reported as md5 and length)."""
    c = dump_classified(spark, sf).filter(F.col("kind") == "insert").withColumn("p", S.insert_payload("value"))
    return c.select("line_no", "tbl_name", F.md5("p").alias("payload_md5"),
                    F.length("p").cast("bigint").alias("payload_len"))


@query
def statement_text(spark, sf):
    """Statement of every line that holds one, up to its last ';' (as md5 and length)."""
    c = dump_classified(spark, sf).filter(F.col("kind").isin("insert", "create", "view") | F.col("value").endswith(";"))
    t = S.statement_text("value")
    return c.select("line_no", F.md5(t).alias("statement_md5"), F.length(t).cast("bigint").alias("statement_len"))


@query
def staging_time(spark, sf):
    """Dumps of a store with their line counts; staging took a time of at least zero, rounded to one decimal; a
    dry run leaves nothing."""
    store = _new_store(spark)
    store.stage(_ord_run(spark, sf, 300), dry_run=True)
    for d in (100, 500):
        store.stage(_ord_run(spark, sf, d))
    m = store.read("stage_meta")
    return m.select("dump_ts", "rowcount", (F.col("parsetime") >= 0).alias("timed"), (F.round("parsetime", 1) == F.col("parsetime")).alias("rounded"))


@query
def scalar_md5(spark, sf):
    """md5 of every line as read (newline included)."""
    return dump_lines(spark, sf).select("line_no", SC.line_md5("value").alias("md5"))


@query
def assemble_create(spark, sf):
    """W4 + A10: CREATE statements assembled from their lines."""
    return S.create_statements(dump_classified(spark, sf)).select("dump_id", "line_no", "tbl_name", "stmt")


@query
def create_payload(spark, sf):
    """P5: column-definition payload of every CREATE."""
    return S.create_statements(dump_classified(spark, sf)).select("tbl_name", S.create_payload("stmt").alias("payload"))


@query
def view_body(spark, sf):
    """SELECT body of every VIEW line."""
    return dump_classified(spark, sf).filter(F.col("kind") == "view").select(
        F.col("tbl_name").alias("name"), S.view_body("value").alias("body"))


@query
def dump_timestamp(spark, sf):
    """W6 + F8: dump time from the last line."""
    return S.dump_timestamp(dump_lines(spark, sf)).select("dump_id", "last_line", "dump_ts")


@query
def dump_rowcount(spark, sf):
    """A2: lines per dump."""
    return S.row_counts(dump_lines(spark, sf)).select("dump_id", F.col("rowcount").cast("bigint").alias("rowcount"))


@query
def dump_fingerprint(spark, sf):
    """A3: order-sensitive two-level digest of the dump."""
    return S.fingerprint(dump_lines(spark, sf))


@query
def skip_tables(spark, sf):
    """Staging with nation skipped — CREATE and INSERT of nation dropped, views kept."""
    st = _stage_dump(dump_lines(spark, sf), DUMP_NS, skip_tables=["nation"])
    return (st.ddl.select(F.lit("create").alias("kind"), F.col("name").alias("tbl_name")).distinct()
            .unionByName(st.manifest.select(F.lit("insert").alias("kind"), "tbl_name").distinct())
            .unionByName(st.views.select(F.lit("view").alias("kind"), F.col("name").alias("tbl_name")).distinct()))


@query
def parse_ddl(spark, sf):
    """columns of every staged CREATE."""
    return dump_schema(spark, sf).select(F.col("name").alias("tbl_name"), "pos", "column", "mysql_type", "unsigned",
                                         "precision", "scale")


@query
def type_mapping(spark, sf):
    """Published SQL type of every column (default and native)."""
    d = dump_schema(spark, sf).select(F.col("name").alias("tbl_name"), "column", "mysql_type", "sql_type", "mapped")
    n = dump_schema(spark, sf, native=True).select(F.col("name").alias("tbl_name"), "column",
                                                    F.col("sql_type").alias("native_type"))
    return d.join(n, ["tbl_name", "column"])


@query
def qualified_columns(spark, sf):
    """Family-qualified cell names."""
    return dump_schema(spark, sf).select(F.col("name").alias("tbl_name"), "pos", "qualified")


@query
def parse_tuples(spark, sf):
    """every tuple of every INSERT with its arity and key."""
    st = dump_staged(spark, sf)
    rows = chunk_rows(st.chunks.select("tbl_name", "md5", "payload"), keep=["tbl_name", "md5"])
    k, _ = token_value(F.element_at("fields", 1))
    return rows.select("tbl_name", "tuple_pos", F.size("fields").alias("arity"), k.cast("bigint").alias("k"))


@query
def rows_to_cells(spark, sf):
    """All DUMP rows as (table, key, column, value, is_null) cells."""
    return dump_cells(spark, sf).select("tbl_name", "row_key", "row_id", "column", "value", "is_null")


@query
def unescape_values(spark, sf):
    """whole document texts recovered from the escaped INSERT text."""
    c = dump_cells(spark, sf).filter((F.col("tbl_name") == "documents") & (F.col("column") == "mysql:text"))
    return c.select(F.col("row_id").alias("doc_id"), F.col("value").alias("text"))


@query
def typed_read(spark, sf):
    """customer cells typed by their DDL with native types (decimal kept exact)."""
    sch = dump_schema(spark, sf, native=True).filter(F.col("name") == "customer").orderBy("pos").select(
        "column", "sql_type").collect()
    cells = dump_cells(spark, sf).filter(F.col("tbl_name") == "customer")
    return RD.typed_asof(cells.withColumn("ts", F.lit(FX.DUMP_ID)), [(r[0], r[1]) for r in sch])


@query
def typed_binary(spark, sf):
    """Blobs written as raw bytes behind an introducer, in hexadecimal and in bits, staged from dump text that
    is not valid UTF-8, published and read back as binary columns (shown in hexadecimal)."""
    st = _stage_dump(DF.dense_lines(FX.blob_lines(spark, sf)), DUMP_NS)
    staged = Staged(st.manifest, st.chunks, st.ddl)
    when = int(st.meta.select("dump_ts").first()[0])  # the dump's own timestamp (one metadata row)
    h, _ = publish_sequence(spark, staged, DUMP_NS, FX.BLOB_TABLE, [when])
    cols, key = table_def(staged, DUMP_NS, FX.BLOB_TABLE, when)
    r = RD.typed_asof(h, cols, when, key=key)
    return r.select("id", F.hex("raw").alias("raw"), F.hex("hex").alias("hex"), F.hex("bits").alias("bits"), "note")


@query
def stage_manifest(spark, sf):
    """K2: manifest rows of the staged DUMP."""
    return dump_staged(spark, sf).manifest


@query
def stage_dump(spark, sf):
    """L1: the dump-level meta row (status, line count, fingerprint) at the parsed dump time."""
    return dump_staged(spark, sf).meta


@query
def ddl_lookup(spark, sf):
    """S3: CREATE payload of each table of the dump."""
    return dump_staged(spark, sf).ddl.select("namespace", "dump_ts", "name", "stmt")


@query
def view_lookup(spark, sf):
    """View statements of the dump."""
    return dump_staged(spark, sf).views.select("namespace", "dump_ts", "name", "stmt")


@query
def manifest_of_dump(spark, sf):
    """Ordered hash list of each table of the dump; tables without INSERTs flagged missing."""
    from tidemark.operators.positions import positions
    st = dump_staged(spark, sf)
    m = positions(st.manifest, ["namespace", "dump_ts", "tbl_name"], "seq", "position")
    t = st.ddl.select("namespace", "dump_ts", F.col("name").alias("tbl_name"))
    return t.join(m, ["namespace", "dump_ts", "tbl_name"], "left").select(
        "tbl_name", "position", "md5", F.col("md5").isNull().alias("missing"))


@query
def stage_chunks_dedup(spark, sf):
    """K1: ORD chunks of dumps 300-500 not already stored by dumps 100-200, one per md5."""
    ch = FX.orders_chunks(spark, sf)
    existing = ch.filter(F.col("dump_ts") <= 200).select("namespace", "tbl_name", "md5", "payload")
    batch = ch.filter(F.col("dump_ts") >= 300).select("namespace", "tbl_name", "md5", "payload")
    return new_chunks_to_store(batch, existing)


# ------------------------------------------------------------------ EV: history reads, versions, tombstones
def _ev(spark, sf):
    return FX.events_cells(spark, sf)


def _id_mid_range(ev):
    """Middle half of the row-id domain, as scalar subqueries (data-derived range bounds)."""
    lo, hi = F.min("row_id"), F.max("row_id")
    first = ev.select(F.floor(lo + (hi - lo) / 4).cast("bigint")).scalar()
    last = ev.select(F.floor(hi - (hi - lo) / 4).cast("bigint")).scalar()
    return first, last


@query
def asof_range_scan(spark, sf):
    """Rows in the middle half of the id domain as of ASOF_T."""
    ev = _ev(spark, sf)
    first, last = _id_mid_range(ev)
    return H.range_scan(ev, first, last, ASOF_T).select("row_key", "column", "row_id", "ts", "value", "is_null")


@query
def row_latest(spark, sf):
    """Latest version of every cell (row get without bound, for every row)."""
    return H.asof(_ev(spark, sf)).select("row_key", "column", "row_id", "ts", "value", "is_null")


@query
def row_asof(spark, sf):
    """Each row read as of its own mid-life time (per-row bound column)."""
    ev = _ev(spark, sf)
    bounds = ev.groupBy("row_key").agg(((F.min("ts") + F.max("ts")) / 2).cast("bigint").alias("bound"))
    return H.asof(ev.join(bounds, "row_key"), F.col("bound")).select(
        "row_key", "column", "row_id", "ts", "value", "is_null")


@query
def cell_versions(spark, sf):
    """Newest three versions of every cell."""
    return H.versions(_ev(spark, sf), 3).select("row_key", "column", "ts", "value", "version")


@query
def cap_versions(spark, sf):
    """K5: history capped at the store's version limit per cell."""
    return H.cap_versions(_ev(spark, sf)).select("row_key", "column", "ts", "value")


@query
def apply_tombstones(spark, sf):
    """K8: every cell version that survives the tombstones (store semantics: regardless of read time)."""
    return H.mask_tombstones(_ev(spark, sf), FX.events_tombstones(spark, sf), mode="literal").select(
        "row_key", "column", "ts", "value")


@query
def tombstone_masked_asof(spark, sf):
    """J8 literal: latest visible state after all tombstones."""
    return H.masked_asof(_ev(spark, sf), FX.events_tombstones(spark, sf), None, "literal").select(
        "row_key", "column", "ts", "value")


@query
def tombstone_asof_corrected(spark, sf):
    """J8 corrected: state as of ASOF_T with only the tombstones issued by then."""
    return H.masked_asof(_ev(spark, sf), FX.events_tombstones(spark, sf), ASOF_T, "corrected").select(
        "row_key", "column", "ts", "value")


EV_TYPES = ["click", "error", "purchase", "signup", "view"]


@query
def state_pivot(spark, sf):
    """Wide state as of ASOF_T, one column per event type (names taken from the data)."""
    ev = _ev(spark, sf)
    names = [r[0] for r in ev.select("column").distinct().orderBy("column").collect()]  # ≤ #columns, metadata
    return H.asof_wide(ev, names, ASOF_T)


@query
def padded_key_order(spark, sf):
    """Cells written clustered by row and read back in file order: each row's place in the files is the rank of its
    numeric id (keys wider than 9 digits included)."""
    o = FX.read(spark, sf, "orders").select("o_orderkey").distinct()
    ids = o.select(F.col("o_orderkey").alias("a")).unionByName(o.select((F.col("o_orderkey") * 100000 + 1).alias("a")))
    path = f"{work_dir(spark)}/clustered-{uuid.uuid4().hex}"
    cells = checkpointed(ids.select(SC.zero_pad("a").alias("row_key"), F.col("a").alias("row_id"), F.lit("c").alias("column"),
                                    F.lit(1).alias("ts")))
    ST.clustered(cells, [], max(1, cells.count() // 4)).write.parquet(path)
    # ranges are dealt to files in order, and names follow the order of the ranges
    stored = spark.read.parquet(path).select("row_key", "row_id", F.col("_metadata.file_name").alias("_f"),
                                             F.col("_metadata.row_index").alias("_m"))
    sizes = stored.groupBy("_f").agg(F.count(F.lit(1)).alias("_n"))  # one row per file
    before = sizes.withColumn("_o", F.coalesce(F.sum("_n").over(
        Window.orderBy("_f").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return stored.join(F.broadcast(before), "_f").select("row_key", "row_id", (F.col("_o") + F.col("_m")).alias("place"))


# ------------------------------------------------------------------ the store: commits, clustered history, bases
from pyspark.sql import Window  # noqa: E402

from tidemark.plans import store as ST  # noqa: E402
from tidemark.plans.stage import StagedDump  # noqa: E402


def _new_store(spark) -> ST.Store:
    return ST.Store(spark, f"{work_dir(spark)}/store-{uuid.uuid4().hex}")


def _ord_run(spark, sf, dump: int, at: int | None = None, tbl: str = TBL, view: bool = False) -> StagedDump:
    """A staging run of the ORD rows of one dump, as the dump of time ``at``, with or without a view."""
    st = ord_staged(spark, sf)
    at = at or dump
    ts = F.lit(at).cast("bigint").alias("dump_ts")
    m = st.manifest.filter(F.col("dump_ts") == dump).select("namespace", ts, F.lit(tbl).alias("tbl_name"), "seq", "md5")
    chunks = st.chunks.join(m.select("md5").distinct(), "md5", "left_semi").select("namespace", F.lit(tbl).alias("tbl_name"), "md5", "payload")
    ddl = m.select("namespace", "dump_ts").distinct().select("namespace", "dump_ts", F.lit(tbl).alias("name"), F.lit(FX.ORD_DDL).alias("stmt"))
    views = ddl.select("namespace", "dump_ts", F.lit("v").alias("name"), F.lit(f"select `id` from `{tbl}`").alias("stmt"))
    meta = m.groupBy("namespace", "dump_ts").agg(F.count(F.lit(1)).alias("rowcount")).select(
        "namespace", "dump_ts", F.lit("staged").alias("status"), "rowcount", F.lit("").alias("md5"))
    return StagedDump(chunks, m, ddl, views if view else views.limit(0), meta)


@query
def restage_dump(spark, sf):
    """K2 / K3 / Q22: dump 100 staged with a view, then staged again with other rows and without it; dump 500 in between. The
    second run replaces the first as a whole; chunks that both need are stored once."""
    store = _new_store(spark)
    store.stage(_ord_run(spark, sf, 100, view=True))
    store.stage(_ord_run(spark, sf, 500, view=True))
    store.stage(_ord_run(spark, sf, 300, at=100))
    m = store.read("stage_manifest").select(F.lit("hash").alias("kind"), "dump_ts", "seq", F.col("md5").alias("value"))
    v = store.read("stage_views").select(F.lit("view").alias("kind"), "dump_ts", F.lit(None).cast("bigint").alias("seq"), F.col("name").alias("value"))
    c = store.read("stage_chunks").select(F.lit("chunk").alias("kind"), F.lit(None).cast("bigint").alias("dump_ts"),
                                          F.lit(None).cast("bigint").alias("seq"), F.md5("payload").alias("value"))
    return m.unionByName(v).unionByName(c)


def _ord_store(spark, sf):
    """Late dumps published with deletes into a store that gets bases in between."""
    def build():
        store = _new_store(spark)
        for d in (100, 300, 400, 500):
            store.stage(_ord_run(spark, sf, d))
        store.publish(NS, TBL, 100, apply_deletes=True)
        store.build_base(NS, TBL, 100)
        store.publish(NS, TBL, 500, apply_deletes=True)
        store.publish(NS, TBL, 400, apply_deletes=True)
        store.build_base(NS, TBL, 400)
        store.publish(NS, TBL, 300, apply_deletes=True)  # older than the newest base
        return store
    return _memo("store", spark, sf, build)


@query
def asof_base_read(spark, sf):
    """The table as of every published dump, each read from one base and the publishes it lacks."""
    store = _ord_store(spark, sf)
    out = None
    for d in (100, 300, 400, 500):
        r = store.read_asof(NS, TBL, d).select(F.lit(d).cast("bigint").alias("dump_ts"), *FX.ORD_COLUMNS)
        out = r if out is None else out.unionByName(r)
    return out


@query
def stored_range_scan(spark, sf):
    """S11 over stored files: cells of the middle half of the rows as of dump 400."""
    store = _ord_store(spark, sf)
    first, last = (int(x) for x in FX.read(spark, sf, "orders").select(
        F.floor(F.min("o_orderkey") + (F.max("o_orderkey") - F.min("o_orderkey")) / 4),
        F.floor(F.max("o_orderkey") - (F.max("o_orderkey") - F.min("o_orderkey")) / 4)).first())
    return store.row_range(NS, TBL, first, last, 400).select("row_key", "row_id", "column", "value", "is_null")


@query
def drop_table(spark, sf):
    """Two tables published, a third only as a dry run, one dropped: rows of the history and the log per table."""
    store = _new_store(spark)
    for t in ("orders", "orders_copy", "orders_dry"):
        store.stage(_ord_run(spark, sf, 100, at=100 + len(t), tbl=t))
        store.publish(NS, t, 100 + len(t), dry_run=t == "orders_dry")
    store.drop(NS, "orders")
    h = store.history().groupBy("tbl_name").agg(F.count(F.lit(1)).alias("n")).select(F.lit("history").alias("kind"), "tbl_name", "n")
    return h.unionByName(store.read("publish_log").select(F.lit("log").alias("kind"), "tbl_name", F.col("dump_ts").alias("n")))


@query
def single_put(spark, sf):
    """K9: a cell of every tenth row put at time 150, between dumps; the table as of 149 and as of 150."""
    store = _new_store(spark)
    store.stage(_ord_run(spark, sf, 100))
    store.publish(NS, TBL, 100)
    row = store.history(NS, TBL).filter((F.col("column") == "mysql:st") & (F.col("row_id") % 10 == 0))
    store.put(NS, TBL, row.select("row_key", "row_id", "column", F.lit("P").alias("value"), F.lit(False).alias("is_null")), 150)
    old = store.read_asof(NS, TBL, 149).select(F.lit(149).cast("bigint").alias("at"), "id", "st")
    return old.unionByName(store.read_asof(NS, TBL, 150).select(F.lit(150).cast("bigint").alias("at"), "id", "st"))


@query
def chunk_point_lookup(spark, sf):
    """The chunks new at dump 500, read through the partitions that the manifest names."""
    store = _ord_store(spark, sf)
    m = store.read("stage_manifest").filter((F.col("namespace") == NS) & (F.col("tbl_name") == TBL))
    new = m.filter(F.col("dump_ts") == 500).join(m.filter(F.col("dump_ts") == 400).select("md5"), "md5", "left_anti")
    return _wanted(store.staged().chunks, new.select("md5", "first_stage", "seq"))[0].select("md5", "seq", "payload")


# ------------------------------------------------------------------ scalars
@query
def scalar_zero_pad(spark, sf):
    """zero padding never truncates."""
    o = FX.read(spark, sf, "orders")
    return o.select("o_orderkey", SC.zero_pad("o_orderkey").alias("k9"),
                    SC.zero_pad(F.col("o_orderkey") * 1000000).alias("k_wide"))


@query
def scalar_unpad(spark, sf):
    """padded integer keys back to text; non-integer keys become null."""
    c = FX.read(spark, sf, "customer")
    return c.select("c_custkey", SC.unpad(SC.zero_pad("c_custkey")).alias("unpadded"),
                    SC.unpad("c_name").alias("name_key"))


def _done_line(ts):
    return F.concat(F.lit(SC.DUMP_DONE_MARK), F.date_format(ts, "yyyy-MM-dd"), F.lit(" "),
                    F.lpad(F.hour(ts).cast("string"), 2, " "), F.lit(":"), F.date_format(ts, "mm:ss"))


@query
def scalar_dump_time(spark, sf):
    """F8 / F9: 'Dump completed on' lines rendered from every event time, parsed back; forced dates too."""
    e = FX.read(spark, sf, "events")
    line = _done_line(F.col("ts"))
    return e.select("event_id", SC.dump_time_epoch(line).alias("dump_ts"),
                    SC.forced_date_epoch(F.date_format("ts", "yyyy-MM-dd")).alias("forced_ts"))


@query
def scalar_epoch_iso(spark, sf):
    """epoch seconds to ISO text with a space."""
    e = FX.read(spark, sf, "events")
    secs = F.floor(SC.ntz_micros("ts") / 1000000).cast("bigint")
    return e.select("event_id", secs.alias("epoch"), SC.epoch_iso(secs).alias("iso"))


# ------------------------------------------------------------------ catalogue, publish views, rebuild
from tidemark.plans import catalog as CAT  # noqa: E402
from tidemark.plans.publish import _dual_state, publish_tables, table_columns  # noqa: E402
from tidemark.plans.rebuild import rebuild_history as _rebuild  # noqa: E402


def _all_ddl(spark, sf):
    return ord_staged(spark, sf).ddl.unionByName(dump_staged(spark, sf).ddl)


@query
def list_tables(spark, sf):
    """Tables of every staged dump (ORD and DUMP namespaces)."""
    return CAT.list_tables(_all_ddl(spark, sf))


@query
def list_views(spark, sf):
    """Views of every staged dump."""
    return CAT.list_views(dump_staged(spark, sf).views)


@query
def list_dumps(spark, sf):
    """Staged dumps with readable time."""
    d = ord_staged(spark, sf).manifest.select("namespace", "dump_ts").unionByName(
        dump_staged(spark, sf).meta.select("namespace", "dump_ts"))
    return CAT.list_dumps(d)


@query
def list_namespaces(spark, sf):
    """Distinct namespaces."""
    return CAT.list_namespaces(ord_staged(spark, sf).manifest, dump_staged(spark, sf).ddl)


def _list_file(spark, sf, names: DataFrame) -> str:
    path = f"{work_dir(spark)}/list-{uuid.uuid4().hex}"
    names.select(F.concat(F.lit("  "), F.col("tbl_name"), F.lit(" \t")).alias("value")).write.text(path)
    return path


@query
def table_list_file(spark, sf):
    """A list file (one padded table name per line) written from the staged tables, read back trimmed."""
    names = dump_staged(spark, sf).ddl.select(F.col("name").alias("tbl_name"))
    return DF.read_list(spark, _list_file(spark, sf, names))


@query
def select_tables(spark, sf):
    """Include list (customer, documents) vs exclude list (nation) over the dump's tables."""
    tables = dump_staged(spark, sf).ddl.select(F.col("name").alias("tbl_name"))
    inc = tables.filter(F.col("tbl_name") != "nation")
    exc = tables.filter(F.col("tbl_name") == "nation")
    a = CAT.select_tables(tables, include=inc, exclude=exc).withColumn("rule", F.lit("include"))
    b = CAT.select_tables(tables, exclude=exc).withColumn("rule", F.lit("exclude"))
    return a.unionByName(b)


@query
def has_data(spark, sf):
    """Which tables have data: DUMP tables, ORD, and one table per nation and market segment, whose rows are the customers
    with a debt of more than 990 (many have none)."""
    st = dump_staged(spark, sf)
    c = FX.read(spark, sf, "customer").select(F.concat_ws("_", F.lit("debt"), F.col("c_nationkey").cast("string"), "c_mktsegment").alias("tbl_name"), "c_acctbal")
    tables = _all_ddl(spark, sf).select(F.col("name").alias("tbl_name")).unionByName(c.select("tbl_name"))
    m = st.manifest.unionByName(ord_staged(spark, sf).manifest.select(st.manifest.columns))
    return CAT.has_data(m.select("tbl_name").unionByName(c.filter("c_acctbal < -990").select("tbl_name")), tables)


@query
def manifest_wide_map(spark, sf):
    """U4 / A4: tables/views/hashes/meta families of the dump manifest, and the paged hash lists of every ORD dump."""
    st = dump_staged(spark, sf)
    o = ord_staged(spark, sf).manifest.select(st.manifest.columns)
    return CAT.manifest_wide(st.ddl, st.views, st.manifest.unionByName(o), st.meta)


def _inorder_history(spark, sf):
    """History of publishing every ORD dump in order, built by the one-pass rebuild (L8, tested equal)."""
    return _memo("inorder", spark, sf, lambda: _rebuild(ord_staged(spark, sf), NS, TBL, FX.ORD_COLUMNS))


def _ord_typed(spark, sf, ts):
    h = _inorder_history(spark, sf)
    if ts is not None:
        h = h.filter(F.col("publish_id") <= ts)
    cols = table_columns(ord_staged(spark, sf), NS, TBL, 500)
    return RD.typed_asof(h, cols, ts)


@query
def published_asof(spark, sf):
    """The published orders table as of dump 300 (deletes not applied), typed by its DDL."""
    return _ord_typed(spark, sf, 300)


@query
def published_table(spark, sf):
    """K7: the published orders table, latest state."""
    return _ord_typed(spark, sf, None)


@query
def schema_only_table(spark, sf):
    """Schema-only publish — the empty typed table."""
    return RD.schema_only(spark, table_columns(ord_staged(spark, sf), NS, TBL, 500))


@query
def apply_views(spark, sf):
    """Publish the dump's customer and nation tables, then create its view over them and read it."""
    st_dump = dump_staged(spark, sf)
    staged = Staged(st_dump.manifest, st_dump.chunks.dropDuplicates(["namespace", "tbl_name", "md5"]), st_dump.ddl)
    when = int(st_dump.meta.select("dump_ts").first()[0])  # the dump's own timestamp (one metadata row)
    tables = ["customer", "nation"]
    for t in tables:
        h, _ = publish_sequence(spark, staged, DUMP_NS, t, [when], materialize=False)
        RD.register(RD.typed_asof(h, table_columns(staged, DUMP_NS, t, when)), DUMP_NS, t)
    views = [(r["name"], r["stmt"]) for r in st_dump.views.select("name", "stmt").collect()]  # DDL-sized
    status = RD.apply_views(spark, views, DUMP_NS, tables)
    bad = [s for s in status if s[1] != "created"]
    if bad:
        raise RuntimeError(f"views failed: {bad}")
    return spark.table(f"{DUMP_NS}_customer_nation")


@query
def publish_namespace(spark, sf):
    """Publish every table of the dump except the excluded ones; cells written per table."""
    st_dump = dump_staged(spark, sf)
    staged = Staged(st_dump.manifest, st_dump.chunks.dropDuplicates(["namespace", "tbl_name", "md5"]), st_dump.ddl)
    when = int(st_dump.meta.select("dump_ts").first()[0])
    tables = [r[0] for r in CAT.select_tables(st_dump.ddl.select(F.col("name").alias("tbl_name")),
                                              exclude=spark.createDataFrame([("nation",)], "tbl_name string"))
              .collect()]  # table names: catalogue metadata
    empty = spark.createDataFrame([], ST.SCHEMAS["history"])
    (r,) = publish_tables(staged, empty, {t: [] for t in tables}, DUMP_NS, when)  # one plan: nothing is published yet
    return r.cells.groupBy("tbl_name").agg(F.count(F.lit(1)).alias("n_cells")).select(
        "tbl_name", F.lit(r.step.status).alias("status"), "n_cells")


@query
def rebuild_history(spark, sf):
    """History rebuilt from all staged dumps in one pass; equals publishing every dump in order."""
    return _rebuild(ord_staged(spark, sf), NS, TBL, FX.ORD_COLUMNS)


@query
def asof_prev_next(spark, sf):
    """State of the late dump's incoming keys as of the previous and the next published dump."""
    st = ord_staged(spark, sf)
    h, r = ord_late(spark, sf)
    inc = r.diff.changed.select("row_key").unionByName(r.diff.identical_next.select("row_key")).distinct()
    new = st.manifest.filter(F.col("dump_ts") == 300).select("md5").distinct().join(
        st.manifest.filter(F.col("dump_ts") == 100).select("md5"), "md5", "left_anti")
    keys = chunk_cells(st.chunks.join(new, "md5", "left_semi").select("md5", "payload"), FX.ORD_COLUMNS,
                       keep=["md5"]).select("row_key").distinct()
    prev, nxt = _dual_state(h.join(keys, "row_key", "left_semi"), 299, 500)
    p = prev.select("row_key", "column", F.col("ts").alias("p_ts"), F.col("value").alias("p_value"))
    n = nxt.select("row_key", "column", F.col("ts").alias("n_ts"), F.col("value").alias("n_value"))
    return p.join(n, ["row_key", "column"], "full")


@query
def diff_suppress(spark, sf):
    """Rows of the late dump fully identical to the next published state (literal mode would not write them)."""
    return _late_diff(spark, sf).full_rows


@query
def diff_stats(spark, sf):
    """Per incoming chunk: its rows, those in the previous and next state, changed rows and the first three changed
    ids (bounded per chunk)."""
    d = _late_diff(spark, sf)
    ch = d.changed.groupBy("md5").agg(
        F.countDistinct("row_key").alias("n_changed_rows"),
        F.array_join(F.slice(F.array_sort(F.collect_set(F.col("row_id"))), 1, 3).cast("array<string>"), ",")
        .alias("preview"))
    return d.chunk_rows.join(ch, "md5", "left").na.fill(0, ["n_changed_rows"])


@query
def chunk_range_join(spark, sf):
    """History rows (after publishing 100) inside the id range of each chunk new at 300 (literal scan)."""
    st = ord_staged(spark, sf)
    h, _ = publish_sequence(spark, st, NS, TBL, [100], materialize=False)
    new = M.new_chunks(st.manifest).filter(F.col("dump_ts") == 300).select("md5")
    cells = chunk_cells(st.chunks.join(new, "md5", "left_semi").select("md5", "payload"), FX.ORD_COLUMNS,
                        keep=["md5"])
    ranges = _chunk_id_range(cells)
    keys = h.select("row_key", "row_id").distinct()
    return D.range_join(ranges, keys).select("md5", "row_key", "row_id")


@query
def published_events(spark, sf):
    """L6 over EV: the event history published as a typed wide table as of ASOF_T (the flagship read)."""
    ev = _ev(spark, sf)
    names = [r[0] for r in ev.select("column").distinct().orderBy("column").collect()]  # ≤ #columns, metadata
    cols = [("user_id", "bigint")] + [(n.split(":", 1)[1], "bigint") for n in names]
    return RD.typed_asof(ev, cols, ASOF_T)


@query
def published_asof_deletes(spark, sf):
    """L3 + L6 with deletes applied (Q5, J13): publish 100, 500, 400, then the late 300; read the table as of every
    published dump. Each read equals its snapshot exactly, absences included."""
    order = [100, 500, 400, 300]
    h, t, _ = publish_sequence_with_deletes(spark, ord_staged(spark, sf), NS, TBL, order)
    out = None
    for d in order:
        r = H.masked_asof(h, t, d, "corrected").select(F.lit(d).cast("bigint").alias("dump_ts"), "row_id", "column",
                                                        "value")
        out = r if out is None else out.unionByName(r)
    return out


@query
def publish_literal(spark, sf):
    """L3 literal mode: publish every dump in order with the original rules — staged milestones (200/400 are
    no-ops), prev/next read over each new chunk's id range (J2), new rows kept only in chunks without earlier rows
    (Q1), rows identical to the next state not written (Q2)."""
    h, _ = publish_sequence(spark, ord_staged(spark, sf), NS, TBL, [100, 200, 300, 400, 500], mode="literal")
    return h


@query
def rebuild_history_deletes(spark, sf):
    """L8 with deletes applied: one-pass rebuild (history + tombstones), read as of every dump; each read equals
    its snapshot exactly."""
    from tidemark.plans.rebuild import rebuild_with_deletes
    h, t = map(checkpointed, rebuild_with_deletes(ord_staged(spark, sf), NS, TBL, FX.ORD_COLUMNS))  # read once per dump
    out = None
    for d in FX.ORD_DUMPS:
        r = H.masked_asof(h, t, d, "corrected").select(F.lit(d).cast("bigint").alias("dump_ts"), "row_id", "column",
                                                        "value")
        out = r if out is None else out.unionByName(r)
    return out
