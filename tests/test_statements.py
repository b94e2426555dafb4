"""Golden mini dump: scan, classify, CREATE assembly, chunk parse, view body, dump time."""

import os

from pyspark.sql import functions as F

from tidemark.functions.ddl import parse_ddl
from tidemark.operators import statements as S
from tidemark.operators.cells import chunk_cells
from tidemark.plans.stage import stage_dump
from tidemark.sources.dumpfile import read_list, scan_dump

GOLDEN = r"""-- MySQL dump 10.13

DROP TABLE IF EXISTS `t`;
CREATE TABLE `t` (
  `id` int(10) unsigned NOT NULL,
  `c1` varchar(32) DEFAULT NULL,
  `c2` enum('a,b','c)') DEFAULT NULL,
  `amt` decimal(18,2) DEFAULT NULL,
  PRIMARY KEY (`id`),
  UNIQUE KEY `u` (`c1`,`c2`) USING BTREE
) ENGINE=InnoDB DEFAULT CHARSET=utf8;
/*!40101 SET character_set_client = @saved_cs_client */;
INSERT INTO `t` VALUES (1,'it\'s','a,b',1.10),(2,'x),(9,\'y','c)',NULL),(3,'',NULL,-0.50);
/*!50001 VIEW `v` AS select `t`.`id` AS `id` from `t` */;
-- Dump completed on 2013-01-20  1:20:00
"""


def _golden(spark, tmp_path, text=GOLDEN, name="golden.sql"):
    p = os.path.join(str(tmp_path), name)
    with open(p, "w") as f:
        f.write(text)
    return scan_dump(spark, p, "g")


def test_scan_and_kinds(spark, tmp_path):
    lines = _golden(spark, tmp_path)
    rows = lines.orderBy("line_no").collect()
    assert len(rows) == 15
    assert [r["line_no"] for r in rows] == list(range(15))
    assert rows[0]["value"] == "-- MySQL dump 10.13"
    kinds = {r["kind"]: r["n"] for r in S.classify(lines).groupBy("kind").agg(F.count("*").alias("n")).collect()}
    assert kinds == {"create": 1, "insert": 1, "view": 1, "useless": 4, "other": 8}


def test_scan_split_file_keeps_order(spark, tmp_path):
    body = "".join(f"-- line {i:06d} {'x' * 50}\n" for i in range(20000))
    p = os.path.join(str(tmp_path), "big.sql")
    with open(p, "w") as f:
        f.write(body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")  # many splits
    try:
        lines = scan_dump(spark, p, 1)
        assert lines.rdd.getNumPartitions() >= 1
        bad = lines.filter(F.col("value") != F.concat(F.lit("-- line "), F.lpad(F.col("line_no").cast("string"), 6, "0"),
                                                      F.lit(" " + "x" * 50))).count()
        assert bad == 0 and lines.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_create_assembly_and_ddl(spark, tmp_path):
    cls = S.classify(_golden(spark, tmp_path))
    creates = S.create_statements(cls).collect()
    assert len(creates) == 1 and creates[0]["tbl_name"] == "t"
    payload = spark.createDataFrame([(creates[0]["stmt"],)], "s string").select(
        S.create_payload("s").alias("payload"))
    cols = [(r["column"], r["mysql_type"]) for r in parse_ddl(payload, keep=[]).orderBy("pos").collect()]
    assert cols == [("id", "int"), ("c1", "varchar"), ("c2", "enum"), ("amt", "decimal")]


def test_literal_create_needs_useless_line(spark, tmp_path):
    text = "CREATE TABLE `a` (\n  `id` int\n);\nINSERT INTO `a` VALUES (1);\nCREATE TABLE `b` (\n  `id` int\n);\n--\n"
    cls = S.classify(_golden(spark, tmp_path, text, "q14.sql"))
    assert sorted(r["tbl_name"] for r in S.create_statements(cls, "corrected").collect()) == ["a", "b"]
    assert [r["tbl_name"] for r in S.create_statements(cls, "literal").collect()] == ["b"]


def test_stage_golden(spark, tmp_path):
    st = stage_dump(_golden(spark, tmp_path), "ns")
    meta = st.meta.collect()[0]
    assert meta["dump_ts"] == 1358644800 and meta["rowcount"] == 15
    assert [r["name"] for r in st.ddl.collect()] == ["t"]
    view = st.views.collect()[0]
    assert (view["name"], view["stmt"]) == ("v", "select `t`.`id` AS `id` from `t`")
    ch = st.chunks.collect()
    assert len(ch) == 1 and ch[0]["tbl_name"] == "t"
    cells = chunk_cells(st.chunks.select("md5", "payload"), ["id", "c1", "c2", "amt"]).collect()
    by = {(r["row_id"], r["column"]): (r["value"], r["is_null"]) for r in cells}
    assert sorted({k[0] for k in by}) == [1, 2, 3]
    assert by[(1, "mysql:c1")] == ("it's", False)
    assert by[(2, "mysql:c1")] == ("x),(9,'y", False)
    assert by[(2, "mysql:amt")] == (None, True)
    assert by[(3, "mysql:c1")] == ("", False)
    assert by[(3, "mysql:c2")] == (None, True)
    assert by[(3, "mysql:amt")] == ("-0.50", False)


def test_skip_tables_keep_views(spark, tmp_path):
    st = stage_dump(_golden(spark, tmp_path), "ns", skip_tables=["t"])
    assert st.ddl.count() == 0 and st.chunks.count() == 0 and st.views.count() == 1


def test_forced_date_wins(spark, tmp_path):
    st = stage_dump(_golden(spark, tmp_path), "ns", forced={"g": "2014-02-03"})
    assert st.meta.first()["dump_ts"] == 1391385600


def test_read_list(spark, tmp_path):
    p = os.path.join(str(tmp_path), "list.txt")
    with open(p, "w") as f:
        f.write("  a \n\nb\t\n")
    assert sorted(r[0] for r in read_list(spark, p).collect()) == ["a", "b"]


def test_long_other_runs_are_not_collected(spark, tmp_path):
    text = ("CREATE TABLE `r` (\n  `id` int\n) ENGINE=InnoDB;\n--\n"
            + "".join(f"REPLACE INTO `r` VALUES ({i});\n" for i in range(3000)) + "-- Dump completed on 2013-01-20  1:20:00\n")
    cls = S.classify(_golden(spark, tmp_path, text, "replace.sql"))
    rows = S.create_statements(cls).collect()
    assert [(r["tbl_name"], r["stmt"]) for r in rows] == [("r", "CREATE TABLE `r` (`id` int) ENGINE=InnoDB;")]


def test_gzip_dump_and_file_md5(spark, tmp_path):
    import gzip
    import hashlib
    from tidemark.sources.dumpfile import file_md5
    p = os.path.join(str(tmp_path), "golden.sql.gz")
    with gzip.open(p, "wt") as f:
        f.write(GOLDEN)
    lines = scan_dump(spark, p, "gz")
    assert lines.count() == 15
    assert lines.filter(F.col("line_no") == 14).first()["value"].startswith("-- Dump completed")
    raw = os.path.join(str(tmp_path), "golden.sql")
    with open(raw, "w") as f:
        f.write(GOLDEN)
    assert file_md5(spark, raw).first()["md5"] == hashlib.md5(GOLDEN.encode()).hexdigest()


def test_crlf_dump(spark, tmp_path):
    p = os.path.join(str(tmp_path), "crlf.sql")
    with open(p, "wb") as f:
        f.write(GOLDEN.replace("\n", "\r\n").encode())
    st = stage_dump(scan_dump(spark, p, "c"), "ns")
    meta = st.meta.first()
    assert meta["dump_ts"] == 1358644800 and meta["rowcount"] == 15
    assert [r["name"] for r in st.ddl.collect()] == ["t"]
    assert st.views.first()["stmt"] == "select `t`.`id` AS `id` from `t`"
    cells = chunk_cells(st.chunks.select("md5", "payload"), ["id", "c1", "c2", "amt"]).collect()
    assert {(r["row_id"], r["column"]): r["value"] for r in cells}[(3, "mysql:amt")] == "-0.50"


def test_stage_many_dumps_in_one_job(spark, tmp_path):
    from tidemark.sources.dumpfile import scan_dumps
    d = tmp_path / "many"
    d.mkdir()
    for day in (0, 1, 2):
        (d / f"d{day}.sql").write_text(GOLDEN.replace("2013-01-20", f"2013-01-2{day}"))
    st = stage_dump(scan_dumps(spark, str(d)), "ns")
    assert sorted(r["dump_ts"] for r in st.meta.collect()) == [1358644800 + k * 86400 for k in range(3)]
    assert st.manifest.count() == 3 and st.chunks.select("md5").distinct().count() == 1
    assert {r["rowcount"] for r in st.meta.collect()} == {15}


def test_names_beyond_the_prefix_and_with_blanks(spark):
    from tidemark.operators.statements import insert_payload, statement_table
    rows = [("INSERT INTO" + " " * 600 + "`far` VALUES (1);", "insert"), ("INSERT INTO `a b` VALUES (1);", "insert"),
            ("CREATE TABLE plain(", "create"), ("INSERT", "insert")]
    df = spark.createDataFrame(rows, "value string, kind string")
    got = [r[0] for r in df.select(statement_table("value", "kind")).collect()]
    assert got == ["far", "a b", "plain", ""]


def test_payload_with_a_long_run_of_blanks(spark):
    from tidemark.operators.statements import insert_payload
    df = spark.createDataFrame([("INSERT INTO `t` VALUES (1,'" + " " * 1_000_000 + "x');  \t",)], "value string")
    assert df.select(insert_payload("value")).first()[0] == "(1,'" + " " * 1_000_000 + "x')"
