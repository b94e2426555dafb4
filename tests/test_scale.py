"""Steps that must not gather their input in one task, one shuffle per dump or one parse per condition."""

from pyspark.sql import functions as F

from tidemark.functions.keys import Key
from tidemark.functions.tuples import FIELD_RX
from tidemark.operators.cells import chunk_cells
from tidemark.session import checkpointed
from tidemark.sources import dumpfile as DF
from tidemark.sources import fixtures as FX


def test_text_lines_of_a_table_spread_over_tasks(spark):
    lines = spark.range(256).select(F.lit(1).alias("dump_id"), (F.col("id") + 3_000_000_000).alias("ord"), F.concat(F.lit("l"), "id").alias("value"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = DF.dense_lines(lines).select("*", F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sorted((r["line_no"], r["value"]) for r in rows) == [(i, f"l{i}") for i in range(256)]
    assert len({r["p"] for r in rows}) > 4


def test_part_files_of_a_dump_grow_with_its_text(spark, tmpdir_run, monkeypatch):
    monkeypatch.setattr(DF, "PART_BYTES", 1000)
    lines = spark.range(200).select((F.col("id") * 7).alias("ord"), F.concat(F.lit("x" * 96), F.lpad(F.col("id").cast("string"), 4, "0")).alias("value"))
    DF.write_dump(lines, f"{tmpdir_run}/d")
    back = DF.scan_dump(spark, f"{tmpdir_run}/d", 1)
    assert [int(r["value"][-4:]) for r in back.orderBy("line_no").collect()] == list(range(200))
    assert len([f for f in spark.read.text(f"{tmpdir_run}/d").inputFiles()]) > 10


def test_stored_frames_are_columnar_and_keep_rows(spark):
    df = spark.sql("select 1 a, cast(null as string) b, named_struct('x', 1, 'y', cast(null as string)) s union all select 2, 'é', null")
    back = checkpointed(df)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert all(f.endswith(".parquet") for f in back.inputFiles())
    assert checkpointed(df.filter("a > 5")).count() == 0


def test_orders_are_shuffled_once_for_all_dumps(spark, tmpdir_run):
    spark.range(1000).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 9).alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        (F.col("id") / 4).alias("o_totalprice"), F.when(F.col("id") % 50 > 0, F.lit("1-URGENT")).alias("o_orderpriority"),
    ).unionByName(spark.sql("select 30L o_orderkey, 1L o_custkey, 'O' o_orderstatus, 7.5D o_totalprice, 'x' o_orderpriority")).write.parquet(
        f"{tmpdir_run}/orders.parquet")
    ch = FX.orders_chunks(spark, tmpdir_run)
    rows = FX.orders_snapshots(spark, tmpdir_run).withColumn("r", FX.order_row_text()).groupBy("dump_ts", "chunk").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "r"))), lambda x: x["r"]), ",").alias("payload"), F.count("*").alias("n_rows"))
    want = sorted(map(tuple, rows.select("dump_ts", "chunk", "payload", "n_rows").collect()))
    assert sorted(map(tuple, ch.select("dump_ts", "seq", "payload", "n_rows").collect())) == want
    assert ch._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_fields_are_split_once_per_row(spark):
    ch = spark.createDataFrame([("m", "(1,2,'a''b\\\\n'),(3,4,NULL)")], "md5 string, payload string")
    cells = chunk_cells(ch, ["a", "b", "c"], keep=["md5"], key=Key(("a", "b"), ("int", "int")))
    assert sorted((r["row_id"], r["column"], r["value"]) for r in cells.collect() if r["value"]) == [
        (1, "mysql:a", "1"), (1, "mysql:b", "2"), (1, "mysql:c", "a'b\\n"), (3, "mysql:a", "3"), (3, "mysql:b", "4")]
    assert cells._jdf.queryExecution().optimizedPlan().toString().count(FIELD_RX) == 1


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _staged(spark, ddl, chunks):
    from tidemark.plans.publish import Staged
    rows = spark.createDataFrame([("n", "t", d, s, f"m{s}-{d}", p) for d, s, p in chunks],
                                 "namespace string, tbl_name string, dump_ts long, seq long, md5 string, payload string")
    defs = rows.select("namespace", "dump_ts").distinct().select("namespace", "dump_ts", F.lit("t").alias("name"), F.lit(ddl).alias("stmt"))
    return Staged(rows.select("namespace", "tbl_name", "dump_ts", "seq", "md5"), rows.select("namespace", "tbl_name", "md5", "payload"), defs)


def test_shared_keys_are_settled_on_whole_rows(spark):
    from tidemark.plans.publish import publish_sequence_with_deletes
    st = _staged(spark, "(`q` int, `a` bigint NOT NULL, `b` varchar(9), `n` int, PRIMARY KEY (`a`,`n`)) ENGINE=InnoDB", [
        (1, 0, "(1,7,'x',1),(2,7,'y',1),(3,8,NULL,2)"), (1, 1, "(4,7,'z',1),(5,NULL,'w',1)"), (2, 0, "(9,7,'z',1),(3,8,'',2),(6,-8,'v''v',2)")])
    h, t, r = publish_sequence_with_deletes(spark, st, "n", "t", [1, 2])
    # nothing was published before: the first dump meets no history, and its cells are stored once
    assert "Join" not in _plan(r[0].diff.writes) and r[0].stored
    key = lambda n, m: f"1{n:020d}1{m:020d}"
    assert [tuple(x) for x in r[0].duplicates.collect()] == [(key(7, 1), 3)]
    cells = {(x["ts"], x["row_key"], x["column"]): x["value"] for x in h.collect()}
    first = {k[1:]: v for k, v in cells.items() if k[0] == 1}
    assert len(first) == 12 and first[key(7, 1), "mysql:q"] == "4" and first[key(7, 1), "mysql:b"] == "z" and first[key(8, 2), "mysql:b"] is None
    low = "0" + "9" * 19 + "11" + f"{2:020d}"
    assert {k[1:]: v for k, v in cells.items() if k[0] == 2} == {
        (key(7, 1), "mysql:q"): "9", (key(8, 2), "mysql:b"): "", (low, "mysql:q"): "6", (low, "mysql:a"): "-8", (low, "mysql:b"): "v'v", (low, "mysql:n"): "2"}
    assert [(x["row_key"], x["ts"]) for x in t.collect()] == [("!" + f"1{1:020d}", 2)]


def test_integer_keys_of_any_notation(spark):
    from tidemark.functions.keys import _encoded, encoded
    odd = ["0", "7", "007", "-5", "-0", "+5", " 5", "5.0", "", "x", "9223372036854775807", "9223372036854775808", "-9223372036854775808", "1" * 30, None]
    df = spark.createDataFrame([(x,) for x in odd], "v string")
    for last in (True, False):
        got = df.select(encoded(F.col("v"), "int", last).alias("e"), _encoded(F.col("v"), "int", last).alias("f")).collect()
        assert [r["e"] for r in got] == [r["f"] for r in got]
    assert df.filter("v = '7'").select(encoded(F.col("v"), "int")).first()[0] == "1" + "7".zfill(20)


def test_rebuild_and_literal_publish_parse_chunks_once(spark):
    from tidemark.plans.publish import publish_sequence
    from tidemark.plans.rebuild import rebuild_with_deletes
    st = _staged(spark, "(`id` bigint NOT NULL, `v` int, PRIMARY KEY (`id`)) ENGINE=InnoDB", [(1, 0, "(1,1),(2,2)"), (2, 0, "(1,1),(3,NULL)")])
    h, t = rebuild_with_deletes(st, "n", "t", ["id", "v"])
    assert "regexp_extract_all" not in _plan(h) and "regexp_extract_all" not in _plan(t)
    assert sorted((x["ts"], x["row_id"], x["value"] or "-") for x in h.collect()) == [(1, 1, "1"), (1, 2, "2"), (2, 3, "-")]
    assert [(x["ts"], x["row_key"]) for x in t.collect()] == [(2, "000000002")]
    h, r = publish_sequence(spark, st, "n", "t", [1, 2], mode="literal")
    assert all("regexp_extract_all" not in _plan(x.diff.writes) for x in r)
    assert "Window" not in _plan(r[1].diff.changed)  # the range join's sweep ran once and its state is stored
    # a new row is written only where its chunk had no rows before
    assert sorted((x["ts"], x["row_id"], x["value"]) for x in h.collect()) == [(1, 1, "1"), (1, 2, "2")]
