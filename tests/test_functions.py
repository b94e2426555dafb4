"""Scalar functions, tuple parsing, DDL parsing."""

from pyspark.sql import functions as F

from tidemark.functions import ddl as DDL
from tidemark.functions import scalars as SC
from tidemark.functions import tuples as TU
from tidemark.sources.fixtures import mysql_escape

# A table with the features that make column parsing hard: quoted commas and parentheses, precision, nested
# expressions, composite and foreign keys.
PARCELS_DDL = (
    "(`parcel` int(11) unsigned NOT NULL AUTO_INCREMENT,`route` char(4) NOT NULL DEFAULT '(,)',"
    "`size` enum('s,m','l)','x''l') DEFAULT NULL COMMENT 'one of (s,m), l, xl',`weight` double(9,3) DEFAULT NULL,"
    "`price` decimal(12,2) unsigned DEFAULT '0.00',`taxed` decimal(14,4) GENERATED ALWAYS AS "
    "(round((((`price`) * (1 + (0.19))) + (0)),2)) STORED,`sent` datetime DEFAULT NULL,`note` mediumtext,"
    "`flag` tinyint(1) NOT NULL DEFAULT '-1' COMMENT '-1:open,0:held,1:done',"
    "PRIMARY KEY (`parcel`,`route`),KEY `by_sent` (`sent`,`route`),"
    "CONSTRAINT `to_route` FOREIGN KEY (`route`) REFERENCES `routes` (`code`),"
    "CONSTRAINT `fair` CHECK ((`price` > (0)) and ((`weight` > (((0))))))) ENGINE=InnoDB AUTO_INCREMENT=77;")

PARCELS_EXPECTED = [("parcel", "int"), ("route", "char"), ("size", "enum"), ("weight", "double"), ("price", "decimal"),
                    ("taxed", "decimal"), ("sent", "datetime"), ("note", "mediumtext"), ("flag", "tinyint")]


def _one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_zero_pad_never_truncates(spark):
    df = spark.createDataFrame([(1,), (123456789,), (1234567890,)], "k long")
    out = [r[0] for r in df.select(SC.zero_pad("k")).collect()]
    assert out == ["000000001", "123456789", "1234567890"]


def test_unpad(spark):
    df = spark.createDataFrame([("000000042",), ("abc",)], "k string")
    assert [r[0] for r in df.select(SC.unpad("k")).collect()] == ["42", None]


def test_dump_time_parse_space_padded_hour(spark):
    assert _one(spark, SC.dump_time_epoch(F.lit("-- Dump completed on 2013-01-20  1:20:00"))) == 1358644800
    assert _one(spark, SC.dump_time_epoch(F.lit("-- Dump completed on 2013-01-20 13:20:00"))) == 1358688000
    assert _one(spark, SC.dump_time_epoch(F.lit("-- something else"))) is None
    assert _one(spark, SC.forced_date_epoch(F.lit("2013-01-20"))) == 1358640000
    assert _one(spark, SC.epoch_iso(F.lit(1358644800))) == "2013-01-20 01:20:00"


def test_line_md5_includes_newline(spark):
    import hashlib
    assert _one(spark, SC.line_md5(F.lit("INSERT x;"))) == hashlib.md5(b"INSERT x;\n").hexdigest()


HOSTILE = ["it's", "back\\slash", "\\\\n literal", "line\nbreak", "tab\there", "nul\x00byte", "ctrl\x1az", "",
           "NULL", "x),(9,'y", "''", "\\'", "end\\", "(", ")", "a,b"]


def test_tuple_round_trip_hostile_strings(spark):
    rows = [(i, s) for i, s in enumerate(HOSTILE)]
    df = spark.createDataFrame(rows, "i long, s string")
    tup = F.concat(F.lit("("), F.col("i").cast("string"), F.lit(",'"), mysql_escape(F.col("s")), F.lit("',NULL)"))
    payload = df.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", tup.alias("t")))),
                                              lambda x: x["t"]), ",").alias("payload"))
    cells = TU.explode_payload(payload, keep=[])
    got = {}
    for r in cells.collect():
        got.setdefault(r["tuple_pos"], {})[r["pos"]] = (r["value"], r["is_null"])
    assert len(got) == len(HOSTILE)
    for i, s in enumerate(HOSTILE):
        assert got[i][1] == (s, False), (i, s, got[i][1])
        assert got[i][2] == (None, True)
        assert got[i][0] == (str(i), False)


def test_long_escaped_string_does_not_overflow(spark):
    s = "a\\'b" * 50000
    df = spark.createDataFrame([(f"(1,'{s}')",)], "payload string")
    cells = TU.explode_payload(df, keep=[]).collect()
    assert len(cells) == 2 and cells[1]["value"] == "a'b" * 50000


def test_parse_ddl_parcels(spark):
    df = spark.createDataFrame([(PARCELS_DDL,)], "payload string")
    rows = DDL.parse_ddl(df, keep=[]).orderBy("pos").collect()
    assert [(r["column"], r["mysql_type"]) for r in rows] == PARCELS_EXPECTED
    by = {r["column"]: r for r in rows}
    assert by["parcel"]["unsigned"] and not by["flag"]["unsigned"]
    assert (by["weight"]["precision"], by["weight"]["scale"]) == (9, 3)
    assert (by["taxed"]["precision"], by["taxed"]["scale"]) == (14, 4)


def test_parse_ddl_composite_key_and_quoted_parens(spark):
    payload = ("(`id` int(10) unsigned NOT NULL,`c1` varchar(32) DEFAULT NULL,`c2` enum('a,b','c)') DEFAULT NULL,"
               "`amt` decimal(18,2) DEFAULT NULL,PRIMARY KEY (`id`),UNIQUE KEY `u` (`c1`,`c2`) USING BTREE"
               ") ENGINE=InnoDB DEFAULT CHARSET=utf8")
    df = spark.createDataFrame([(payload,)], "payload string")
    rows = DDL.with_types(DDL.parse_ddl(df, keep=[]), native=True).orderBy("pos").collect()
    assert [(r["column"], r["mysql_type"]) for r in rows] == [("id", "int"), ("c1", "varchar"), ("c2", "enum"),
                                                             ("amt", "decimal")]
    assert [r["sql_type"] for r in rows] == ["bigint", "string", "string", "decimal(18,2)"]


def test_type_map_unknown_is_string_not_mapped(spark):
    df = spark.createDataFrame([("(`id` int,`flag` bit(1),`j` json,`b` longblob)",)], "payload string")
    rows = DDL.with_types(DDL.parse_ddl(df, keep=[])).orderBy("pos").collect()
    assert [(r["sql_type"], r["mapped"]) for r in rows] == [("int", True), ("string", False), ("string", False),
                                                           ("binary", True)]


def test_typed_read_is_null_safe(spark):
    df = spark.createDataFrame([("12",), ("NULL",), ("x",)], "v string")
    assert [r[0] for r in df.select(DDL.typed_read("v", "int")).collect()] == [12, None, None]
