"""Frames derived from the driver's Parquet tables (there is no dump file among them).

EV   — a versioned cell history from ``events`` (one cell version per event).
ORD  — five snapshots of ``orders`` with deletes, inserts, updates and a removed-then-restored chunk, staged as
       100-row INSERT chunks addressed by md5.
DUMP — mysqldump-style text lines rendered from ``customer``, ``nation`` and ``documents`` with hostile strings.

Every frame is a plain DataFrame plan over the tables, so its size grows with the scale factor. The same rules are
written as SQL in ``tidemark.oracle`` for the DuckDB cross-check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import ntz_micros, qualified, zero_pad

NAMESPACE = "shop"
ORD_TABLE = "orders"
ORD_CHUNK = 100  # ids per INSERT chunk
ORD_DUMPS = [100, 200, 300, 400, 500]
# CREATE payload of the ORD table as it appears in a dump (char is not in the type map: published as string).
ORD_DDL = ("(`id` bigint(20) NOT NULL,`custkey` bigint(20) DEFAULT NULL,`st` char(1) DEFAULT NULL,"
           "`cents` bigint(20) DEFAULT NULL,`pr` varchar(15) DEFAULT NULL,PRIMARY KEY (`id`)) "
           "ENGINE=InnoDB DEFAULT CHARSET=utf8")
ORD_COLUMNS = ["id", "custkey", "st", "cents", "pr"]

DUMP_ID = 1
DUMP_CHUNK = 100  # rows per INSERT line
DUMP_DONE_LINE = "-- Dump completed on 2013-01-20  1:20:00"

# Fixed text of the DUMP frame: table layout (column, declaration, render kind) mirroring the Parquet schemas.
DUMP_TABLES = [
    ("customer", "c_custkey", [
        ("c_custkey", "bigint(20) NOT NULL", "int"),
        ("c_name", "varchar(25) DEFAULT NULL", "str"),
        ("c_nationkey", "int(11) DEFAULT NULL", "int"),
        ("c_acctbal", "decimal(15,2) DEFAULT NULL", "money"),
        ("c_mktsegment", "varchar(10) DEFAULT NULL", "str"),
    ], ["PRIMARY KEY (`c_custkey`)", "KEY `c_nationkey` (`c_nationkey`,`c_custkey`) USING BTREE"]),
    ("nation", "n_nationkey", [
        ("n_nationkey", "int(11) NOT NULL", "int"),
        ("n_name", "varchar(25) DEFAULT NULL", "str"),
        ("n_regionkey", "int(11) DEFAULT NULL", "int"),
    ], ["PRIMARY KEY (`n_nationkey`)"]),
    ("documents", "doc_id", [
        ("doc_id", "bigint(20) unsigned NOT NULL", "int"),
        ("text", "mediumtext", "str"),
        ("lang", "enum('en','fr','de','es','x,y)') DEFAULT NULL", "str"),
        ("source", "varchar(64) DEFAULT NULL COMMENT 'origin, (feed)'", "str"),
        ("n_chars", "bigint(20) DEFAULT NULL", "int"),
    ], ["PRIMARY KEY (`doc_id`)"]),
]
DUMP_HEADER = [
    "-- MySQL dump 10.13  Distrib 5.5.28, for debian-linux-gnu (x86_64)",
    "--",
    "-- Host: localhost    Database: shop",
    "-- ------------------------------------------------------",
    "-- Server version\t5.5.28-0ubuntu0.12.04.3",
    "",
    "/*!40101 SET @OLD_CHARACTER_SET_CLIENT=@@CHARACTER_SET_CLIENT */;",
    "/*!40101 SET NAMES utf8 */;",
    "",
]
DUMP_VIEW_LINES = [
    "--",
    "-- Final view structure for view `customer_nation`",
    "--",
    "",
    "/*!50001 DROP TABLE IF EXISTS `customer_nation`*/;",
    "/*!50001 CREATE ALGORITHM=UNDEFINED */",
    "/*!50013 DEFINER=`root`@`localhost` SQL SECURITY DEFINER */",
    "/*!50001 VIEW `customer_nation` AS select `c`.`c_custkey` AS `c_custkey`,`n`.`n_name` AS `n_name` "
    "from (`customer` `c` join `nation` `n` on((`c`.`c_nationkey` = `n`.`n_nationkey`))) */;",
    "",
]
DUMP_FOOTER = [
    "/*!40101 SET CHARACTER_SET_CLIENT=@OLD_CHARACTER_SET_CLIENT */;",
    "",
    DUMP_DONE_LINE,
]
TABLE_BLOCK = 1_000_000_000  # ord offset per table block
INSERT_OFFSET = 1_000
TRAILER_OFFSET = 500_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- EV
def events_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EV: (event_id, row_id, row_key, column, ts µs, value, is_null) — one cell version per event."""
    ev = read(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.col("user_id").alias("row_id"),
        zero_pad("user_id").alias("row_key"),
        qualified("event_type").alias("column"),
        ntz_micros("ts").alias("ts"),
        F.round(F.col("value") * 100).cast("bigint").cast("string").alias("value"),
        F.lit(False).alias("is_null"),
    )


def events_tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EV tombstones (row_key, column, ts): every 50th event deletes its cell, every 500th its whole row."""
    c = events_cells(spark, sf_dir).filter(F.col("event_id") % 50 == 0)
    return c.select(
        "row_key",
        F.when(F.col("event_id") % 500 == 0, F.lit(None).cast("string")).otherwise(F.col("column")).alias("column"),
        "ts",
    )


# ---------------------------------------------------------------- ORD
def _orders_base(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column]:
    """Orders with what each dump holds of them: ``in1`` (dumps 100 and 200) and ``in3`` (300 to 500) tell presence, ``st3`` and
    ``cents5`` the values from 300 and 500 on. Also the last chunk, which dump 400 lacks (a scalar subquery, evaluated once)."""
    o = read(spark, sf_dir, "orders")
    chunk = F.floor(F.col("o_orderkey") / ORD_CHUNK).cast("bigint")
    b = o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderstatus").alias("st"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        F.col("o_orderpriority").alias("pr"),
        chunk.alias("chunk"),
        ((chunk % 3) == 0).alias("ch"),
    )
    idc, ch = F.col("id"), F.col("ch")
    rows = b.select(
        "id", "custkey", "st", "cents", "pr", "chunk", (idc % 10 != 7).alias("in1"),
        (((idc % 10 != 7) & ~(ch & (idc % 17 == 0))) | (ch & (idc % 20 == 7))).alias("in3"),
        F.when(ch & (idc % 130 == 0), F.lit("X")).otherwise(F.col("st")).alias("st3"),
        F.when(ch & (idc % 260 == 1), F.col("cents") + 1).otherwise(F.col("cents")).alias("cents5"))
    return rows.filter("in1 or in3"), b.select(F.max("chunk")).scalar()


def orders_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORD: (dump_ts, id, custkey, st, cents, pr, chunk) for dumps 100..500."""
    rows, max_chunk = _orders_base(spark, sf_dir)
    d = F.col("dump_ts")
    each = rows.withColumn("dump_ts", F.explode(F.array(*[F.lit(x).cast("bigint") for x in ORD_DUMPS]))).filter(
        F.when(d < 300, F.col("in1")).otherwise(F.col("in3")) & ((d != 400) | (F.col("chunk") < max_chunk)))
    return each.select("dump_ts", "id", "custkey", F.when(d < 300, F.col("st")).otherwise(F.col("st3")).alias("st"),
                       F.when(d < 500, F.col("cents")).otherwise(F.col("cents5")).alias("cents"), "pr", "chunk")


def order_row_text(st: str = "st", cents: str = "cents") -> Column:
    q = F.lit("'")
    return F.concat(F.lit("("), F.col("id").cast("string"), F.lit(","), F.col("custkey").cast("string"), F.lit(","),
                    q, F.col(st), q, F.lit(","), F.col(cents).cast("string"), F.lit(","), q, F.col("pr"), q,
                    F.lit(")"))


def orders_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ORD staged: (namespace, tbl_name, dump_ts, seq, md5, payload, n_rows) — one INSERT chunk per 100 ids.

    The group is one chunk (≤ 100 rows), so the ordered collect is bounded."""
    rows, max_chunk = _orders_base(spark, sf_dir)
    own = F.collect_list(F.struct("id", "in1", "in3", *[order_row_text(st, cents).alias(r) for r, st, cents in (
        ("r1", "st", "cents"), ("r3", "st3", "cents"), ("r5", "st3", "cents5"))]))
    g = rows.groupBy("chunk").agg(own.alias("o"))  # one shuffle of the orders serves all dumps
    texts = {}
    for r, kept in (("r1", "in1"), ("r3", "in3"), ("r5", "in3")):
        mine = F.sort_array(F.transform(F.filter("o", lambda x: x[kept]), lambda x: F.struct(x["id"].alias("id"), x[r].alias("r"))))  # noqa: B023
        texts[r] = F.struct(F.concat_ws(",", mine["r"]).alias("payload"), F.size(mine).cast("bigint").alias("n_rows"))
    g = g.select("chunk", *[t.alias(r) for r, t in texts.items()])
    dumps = F.array(*[F.struct(F.lit(d).cast("bigint").alias("dump_ts"), F.col(r).alias("t"))
                      for d, r in zip(ORD_DUMPS, ("r1", "r1", "r3", "r3", "r5"))])
    g = g.select("chunk", F.explode(dumps).alias("d")).select("d.dump_ts", "chunk", "d.t.payload", "d.t.n_rows").filter(
        (F.col("n_rows") > 0) & ((F.col("dump_ts") != 400) | (F.col("chunk") < max_chunk)))
    return g.select(
        F.lit(NAMESPACE).alias("namespace"), F.lit(ORD_TABLE).alias("tbl_name"), "dump_ts",
        F.col("chunk").alias("seq"), F.md5("payload").alias("md5"), "payload", "n_rows",
    )


# ---------------------------------------------------------------- LINE and CODE: composite and text keys
LINE_TABLE, CODE_TABLE, BLOB_TABLE = "lines", "codes", "blobs"
LINE_DDL = ("(`l_quantity` bigint(20) DEFAULT NULL,`l_orderkey` bigint(20) NOT NULL,`l_partkey` bigint(20) DEFAULT NULL,"
            "`l_returnflag` varchar(1) DEFAULT NULL,`l_linenumber` int(11) NOT NULL,"
            "PRIMARY KEY (`l_orderkey`,`l_linenumber`),KEY `p` (`l_partkey`)) ENGINE=InnoDB")
LINE_COLUMNS = ["l_quantity", "l_orderkey", "l_partkey", "l_returnflag", "l_linenumber"]
LINE_DUMPS = [100, 200]
CODE_DDL = "(`name` varchar(55) DEFAULT NULL,`code` varchar(30) NOT NULL,PRIMARY KEY (`code`)) ENGINE=InnoDB"


def rendered(columns: list[tuple[str, str]]) -> Column:
    """Tuple text of (column, render kind) pairs."""
    parts = [x for c, kind in columns for x in (render_value(F.col(c), kind), F.lit(","))]
    return F.concat(F.lit("("), *parts[:-1], F.lit(")"))


def _chunked(rows: DataFrame, tbl: str) -> DataFrame:
    """(namespace, tbl_name, dump_ts, seq, md5, payload) of (dump_ts, chunk, order, r) rows; a chunk is bounded."""
    g = rows.groupBy("dump_ts", "chunk").agg(
        F.concat_ws(",", F.sort_array(F.collect_list(F.struct("order", "r")))["r"]).alias("payload"))
    return g.select(F.lit(NAMESPACE).alias("namespace"), F.lit(tbl).alias("tbl_name"), F.col("dump_ts").cast("bigint").alias("dump_ts"),
                    F.col("chunk").alias("seq"), F.md5("payload").alias("md5"), "payload")


def line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LINE: two dumps of ``lineitem`` keyed by order and line number. The given rows repeat keys, so keys have several puts;
    dump 200 adds orders, changes quantities and drops first lines."""
    li = read(spark, sf_dir, "lineitem").select(
        F.round("l_quantity").cast("bigint").alias("l_quantity"), "l_orderkey", "l_partkey", "l_returnflag", "l_linenumber")
    o, n = F.col("l_orderkey"), F.col("l_linenumber")
    li = li.withColumn("q2", F.col("l_quantity") + F.when((o % 11 == 0) & (n == 2), 1).otherwise(0))
    own = {}
    for d, q, kept in ((100, "l_quantity", o % 7 != 3), (200, "q2", ~((o % 13 == 0) & (n == 1)))):
        r = rendered([(q, "int"), ("l_orderkey", "int"), ("l_partkey", "int"), ("l_returnflag", "str"), ("l_linenumber", "int")])
        own[d] = F.when(kept, F.struct("l_orderkey", "l_linenumber", "l_partkey", F.col(q), "l_returnflag", r.alias("r")))
    # one shuffle of the lines serves both dumps; a row that a dump lacks is null and not collected
    g = li.groupBy(F.floor(o / 50).cast("bigint").alias("chunk")).agg(*[F.collect_list(x).alias(f"d{d}") for d, x in own.items()])
    dumps = F.array(*[F.struct(F.lit(d).cast("bigint").alias("dump_ts"), F.size(f"d{d}").alias("n"),
                               F.concat_ws(",", F.sort_array(f"d{d}")["r"]).alias("payload")) for d in own])
    g = g.select("chunk", F.explode(dumps).alias("d")).filter("d.n > 0")
    return g.select(F.lit(NAMESPACE).alias("namespace"), F.lit(LINE_TABLE).alias("tbl_name"), "d.dump_ts", F.col("chunk").alias("seq"),
                    F.md5("d.payload").alias("md5"), "d.payload")


def code_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CODE: ``part`` under text keys that differ only in leading zeros."""
    p = read(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("name"), F.explode(F.array(F.lit(""), F.lit("0"), F.lit("00"), F.lit("x"))).alias("zeros"))
    rows = p.withColumn("code", F.concat("zeros", F.col("p_partkey").cast("string"))).select(
        F.lit(100).alias("dump_ts"), F.floor(F.col("p_partkey") / 100).cast("bigint").alias("chunk"), F.struct("p_partkey", "zeros").alias("order"),
        rendered([("name", "str"), ("code", "str")]).alias("r"))
    return _chunked(rows, CODE_TABLE)


# ---------------------------------------------------------------- BLOB: bytes in every notation
BLOB_CREATE = ("CREATE TABLE `blobs` (`id` bigint(20) NOT NULL, `raw` longblob, `hex` longblob, `bits` longblob, `note` varchar(40), "
               "PRIMARY KEY (`id`)) ENGINE=InnoDB;")


def blob_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BLOB: (dump_id, ord, value) lines of a dump of ``customer`` whose blobs stand as raw bytes behind an introducer, as
    hexadecimal and as bit literals. The raw bytes are md5 digests, so the lines are not valid UTF-8."""
    c = read(spark, sf_dir, "customer")
    digest = F.unhex(F.md5("c_name"))
    quoted = lambda b: F.encode(F.concat(F.lit("'"), mysql_escape(F.decode(b, "ISO-8859-1")), F.lit("'")), "ISO-8859-1")
    put = lambda x: F.encode(x, "UTF-8")
    hexed = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("0x"), F.md5("c_name"))).otherwise(
        F.concat(F.lit("x'"), F.upper(F.md5("c_name")), F.lit("'")))
    bits = F.concat(F.lit("b'"), F.conv((F.col("c_custkey") % 1024).cast("string"), 10, 2), F.lit("'"))
    row = F.concat(put(F.concat(F.lit("("), F.col("c_custkey").cast("string"), F.lit(",_binary "))), quoted(digest),
                   put(F.concat(F.lit(","), hexed, F.lit(","), bits, F.lit(",_utf8 '"), mysql_escape(F.concat("c_name", F.lit(" é'\\"))), F.lit("')"))))
    chunk = F.floor(F.col("c_custkey") / DUMP_CHUNK).cast("bigint")
    rows = c.select(chunk.alias("chunk"), "c_custkey", F.hex(row).alias("h")).groupBy("chunk").agg(
        F.unhex(F.concat_ws("2C", F.sort_array(F.collect_list(F.struct("c_custkey", "h")))["h"])).alias("body"))
    inserts = rows.select(F.lit(3).cast("bigint").alias("dump_id"), (F.col("chunk") + 10).alias("ord"),
                          F.concat(put(F.lit(f"INSERT INTO `{BLOB_TABLE}` VALUES ")), "body", put(F.lit(";"))).cast("string").alias("value"))
    last = F.lit(1 << 40).cast("bigint")
    text = spark.createDataFrame([(3, 0, BLOB_CREATE), (3, 1, "")], "dump_id bigint, ord bigint, value string").unionByName(
        rows.agg(F.lit(3).cast("bigint").alias("dump_id"), last.alias("ord"), F.lit(DUMP_DONE_LINE).alias("value")))
    return text.unionByName(inserts)


# ---------------------------------------------------------------- DUMP
def mysql_escape(x: Column) -> Column:
    """String literal body as mysqldump writes it."""
    for src, dst in [("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r"), ("\u0000", "\\0"), ("\u001a", "\\Z")]:
        x = F.replace(x, F.lit(src), F.lit(dst))
    return x


def render_value(c: Column, kind: str) -> Column:
    if kind == "int":
        v = c.cast("string")
    elif kind == "money":
        v = c.cast("decimal(15,2)").cast("string")
    else:
        v = F.concat(F.lit("'"), mysql_escape(c), F.lit("'"))
    return F.coalesce(v, F.lit("NULL"))


def dump_source_rows(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Table rows as they are rendered into DUMP, with injected hostile values."""
    df = read(spark, sf_dir, table)
    if table == "customer":
        df = df.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 11 == 0, F.lit(None).cast("string"))
                           .otherwise(F.col("c_mktsegment")))
    if table == "documents":
        k = F.col("doc_id")
        hostile = F.concat(F.lit(" "), F.lit("'"), F.lit("q"), F.lit("\\"), F.lit("b ),(9,"), F.lit("'"), F.lit("x"),
                           F.lit("\\\\"), F.lit("n"))
        df = df.withColumn("text", F.when(k % 5 == 0, F.concat(F.col("text"), hostile)).otherwise(F.col("text")))
        df = df.withColumn("source", F.when(k % 7 == 3, F.lit("NULL"))
                           .when(k % 7 == 4, F.lit(None).cast("string")).otherwise(F.col("source")))
    return df


def _structure_lines(table: str, cols, keys) -> list[str]:
    body = [f"  `{c}` {decl}," for c, decl, _ in cols]
    tail = [f"  {k}," for k in keys]
    tail[-1] = tail[-1].rstrip(",")
    return [
        "--", f"-- Table structure for table `{table}`", "--", "",
        f"DROP TABLE IF EXISTS `{table}`;",
        "/*!40101 SET @saved_cs_client     = @@character_set_client */;",
        "/*!40101 SET character_set_client = utf8 */;",
        f"CREATE TABLE `{table}` (",
        *body, *tail,
        ") ENGINE=InnoDB DEFAULT CHARSET=utf8;",
        "/*!40101 SET character_set_client = @saved_cs_client */;",
        "", "--", f"-- Dumping data for table `{table}`", "--", "",
        f"LOCK TABLES `{table}` WRITE;",
        f"/*!40000 ALTER TABLE `{table}` DISABLE KEYS */;",
    ]


def _trailer_lines(table: str) -> list[str]:
    return [f"/*!40000 ALTER TABLE `{table}` ENABLE KEYS */;", "UNLOCK TABLES;", ""]


def dump_text_lines() -> list[tuple[int, str]]:
    """The non-data lines of DUMP with their ord (schema metadata and mysqldump boilerplate)."""
    out = [(i, s) for i, s in enumerate(DUMP_HEADER)]
    for ti, (table, _key, cols, keys) in enumerate(DUMP_TABLES, start=1):
        base = ti * TABLE_BLOCK
        out += [(base + i, s) for i, s in enumerate(_structure_lines(table, cols, keys))]
        out += [(base + TRAILER_OFFSET + i, s) for i, s in enumerate(_trailer_lines(table))]
    base = (len(DUMP_TABLES) + 1) * TABLE_BLOCK
    out += [(base + i, s) for i, s in enumerate(DUMP_VIEW_LINES)]
    base = (len(DUMP_TABLES) + 2) * TABLE_BLOCK
    out += [(base + i, s) for i, s in enumerate(DUMP_FOOTER)]
    return out


def dump_insert_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INSERT lines of DUMP: one per 100 consecutive keys of each table (bounded groups)."""
    frames = []
    for ti, (table, key, cols, _keys) in enumerate(DUMP_TABLES, start=1):
        df = dump_source_rows(spark, sf_dir, table)
        parts = []
        for c, _decl, kind in cols:
            parts += [render_value(F.col(c), kind), F.lit(",")]
        tup = F.concat(F.lit("("), *parts[:-1], F.lit(")"))
        g = df.select(F.col(key).cast("bigint").alias("k"), tup.alias("t")).groupBy(
            F.floor(F.col("k") / DUMP_CHUNK).cast("bigint").alias("chunk")
        ).agg(F.concat_ws(",", F.sort_array(F.collect_list(F.struct("k", "t")))["t"])
              .alias("vals"))
        frames.append(g.select(
            F.lit(DUMP_ID).cast("bigint").alias("dump_id"),
            (F.lit(ti * TABLE_BLOCK + INSERT_OFFSET) + F.col("chunk")).cast("bigint").alias("ord"),
            F.concat(F.lit(f"INSERT INTO `{table}` VALUES "), F.col("vals"), F.lit(";")).alias("value"),
        ))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def dump_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DUMP: (dump_id, ord, value)."""
    text = spark.createDataFrame([(DUMP_ID, o, v) for o, v in dump_text_lines()],
                                 "dump_id bigint, ord bigint, value string")
    return text.unionByName(dump_insert_lines(spark, sf_dir))
