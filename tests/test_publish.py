"""Publishing: the as-of invariant under any publish order, L8 = in-order publishing, idempotence, store I/O."""

import itertools
import os

import pytest
from pyspark.sql import functions as F

from tidemark import queries as QM
from tidemark.operators import history as H
from tidemark.plans.publish import publish_sequence
from tidemark.plans.rebuild import rebuild_history
from tidemark.plans.stage import stage_dump
from tidemark.plans.store import Store
from tidemark.sources import fixtures as FX
from tidemark.sources.dumpfile import scan_dump, write_dump

SF = "/root/testdata/sf0.001"
NS, TBL = FX.NAMESPACE, FX.ORD_TABLE


def _snapshot_cells(spark, d):
    s = FX.orders_snapshots(spark, SF).filter(F.col("dump_ts") == d)
    return {(int(r["id"]), c): str(r[c]) for r in s.collect() for c in ("custkey", "st", "cents", "pr")}


def _read(h, d):
    return {(int(r["row_id"]), r["column"].split(":")[1]): r["value"] for r in H.asof(h, d).collect()}


@pytest.fixture(scope="module")
def staged(spark):
    return QM.ord_staged(spark, SF)


@pytest.mark.parametrize("order", list(itertools.permutations([100, 300, 500])))
def test_invariant_any_order(spark, staged, order):
    """After publishing in any order, reading as of d restricted to d's ids equals snapshot d."""
    h, _ = publish_sequence(spark, staged, NS, TBL, list(order))
    for d in order:
        snap = _snapshot_cells(spark, d)
        got = _read(h, d)
        ids = {k[0] for k in snap}
        assert {k: v for k, v in got.items() if k[0] in ids} == snap, (order, d)


def test_rebuild_equals_in_order(spark, staged):
    h, _ = publish_sequence(spark, staged, NS, TBL, [100, 200, 300, 400, 500])
    cols = ["row_key", "column", "ts", "value"]
    a = sorted(tuple(r) for r in h.select(*cols).collect())
    b = sorted(tuple(r) for r in rebuild_history(staged, NS, TBL, FX.ORD_COLUMNS).select(*cols).collect())
    assert a == b


def test_republish_is_noop(spark, staged):
    h1, _ = publish_sequence(spark, staged, NS, TBL, [100, 300])
    h2, res = publish_sequence(spark, staged, NS, TBL, [300], history=h1, log=[100, 300])
    assert res[0].status == "unchanged" and h2.count() == h1.count()


def test_literal_mode_non_milestone_is_noop(spark, staged):
    _, res = publish_sequence(spark, staged, NS, TBL, [100, 200], mode="literal")
    assert [r.status for r in res] == ["published", "unchanged"]


def test_store_end_to_end(spark, tmp_path):
    """Stage a dump file into a Parquet store, publish two dumps, read typed as of each."""
    root = str(tmp_path / "store")
    store = Store(spark, root)
    lines = FX.dump_lines(spark, SF)
    p1 = write_dump(lines, str(tmp_path / "d1"))
    store.stage(stage_dump(scan_dump(spark, p1, 1), "s"))
    # second dump: one nation renamed, different dump date
    n2 = lines.withColumn("value", F.regexp_replace("value", "NATION_3'", "NATION_X'")).withColumn(
        "value", F.regexp_replace("value", "2013-01-20", "2013-01-21"))
    p2 = write_dump(n2, str(tmp_path / "d2"))
    store.stage(stage_dump(scan_dump(spark, p2, 2), "s"))
    assert store.read("stage_meta").count() == 2
    chunks = store.read("stage_chunks")
    assert chunks.count() == chunks.select("md5").distinct().count()  # content-addressed, stored once
    t1, t2 = 1358644800, 1358644800 + 86400
    r1 = store.publish("s", "nation", t1)
    assert r1.status == "published"
    assert store.publish("s", "nation", t1).status == "unchanged"
    store.publish("s", "nation", t2)
    old = {r["n_nationkey"]: r["n_name"] for r in store.read_asof("s", "nation", t1).collect()}
    new = {r["n_nationkey"]: r["n_name"] for r in store.read_asof("s", "nation", t2).collect()}
    assert old[3] == "NATION_3" and new[3] == "NATION_X" and len(new) == 25
    h = store.read("history").filter(F.col("publish_id") == t2)
    assert h.count() == 1  # only the changed cell was written


def _read_masked(h, t, d):
    from tidemark.operators.history import masked_asof
    return {(int(r["row_id"]), r["column"].split(":")[1]): r["value"]
            for r in masked_asof(h, t, d, "corrected").collect()}


@pytest.mark.parametrize("order", [[100, 300, 400, 500], [500, 100, 400, 300], [400, 100, 500, 300],
                                   [300, 500, 100, 400], [100, 200, 300, 400, 500]])
def test_apply_deletes_exact_invariant(spark, staged, order):
    """With deletes applied, reading as of any published dump equals that dump exactly (absences included)."""
    from tidemark.plans.publish import publish_sequence_with_deletes
    h, t, _ = publish_sequence_with_deletes(spark, staged, NS, TBL, order)
    for d in order:
        assert _read_masked(h, t, d) == _snapshot_cells(spark, d), (order, d)


def test_store_apply_deletes_drop_and_rebuild(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store2"))
    lines = FX.dump_lines(spark, SF)
    p1 = write_dump(lines, str(tmp_path / "e1"))
    store.stage(stage_dump(scan_dump(spark, p1, 1), "s"))
    # second dump: nation 3 deleted (its whole INSERT chunk changes), one day later
    n2 = lines.withColumn("value", F.regexp_replace("value", r",\(3,'NATION_3',3\)", "")).withColumn(
        "value", F.regexp_replace("value", "2013-01-20", "2013-01-21"))
    p2 = write_dump(n2, str(tmp_path / "e2"))
    store.stage(stage_dump(scan_dump(spark, p2, 2), "s"))
    t1, t2 = 1358644800, 1358644800 + 86400
    store.publish("s", "nation", t1, apply_deletes=True)
    store.publish("s", "nation", t2, apply_deletes=True)
    assert 3 in {r["n_nationkey"] for r in store.read_asof("s", "nation", t1).collect()}
    assert 3 not in {r["n_nationkey"] for r in store.read_asof("s", "nation", t2).collect()}
    store.drop("s", "nation")
    assert store.published("s", "nation") == []
    store.rebuild("s", "nation")
    assert sorted(store.published("s", "nation")) == [t1, t2]
    assert store.read_asof("s", "nation", t1).count() == 25


def test_literal_publish_loses_inserts_in_overlapping_chunks(spark, staged):
    """Q1: in literal mode a new row is only written when its chunk had no earlier rows."""
    lit, _ = publish_sequence(spark, staged, NS, TBL, [100, 300, 500], mode="literal")
    cor, _ = publish_sequence(spark, staged, NS, TBL, [100, 300, 500])
    new_ids = {k[0] for k in _snapshot_cells(spark, 300)} - {k[0] for k in _snapshot_cells(spark, 100)}
    assert new_ids
    lit_ids = {int(r[0]) for r in lit.select("row_id").distinct().collect()}
    cor_ids = {int(r[0]) for r in cor.select("row_id").distinct().collect()}
    assert new_ids <= cor_ids and not (new_ids & lit_ids)


def test_literal_nulls_are_strings(spark):
    from tidemark.operators.cells import chunk_cells
    df = spark.createDataFrame([("m", "(1,NULL,'NULL')")], "md5 string, payload string")
    cor = {r["column"]: (r["value"], r["is_null"]) for r in chunk_cells(df, ["id", "a", "b"]).collect()}
    lit = {r["column"]: (r["value"], r["is_null"]) for r in chunk_cells(df, ["id", "a", "b"], literal_nulls=True).collect()}
    assert cor == {"mysql:a": (None, True), "mysql:b": ("NULL", False)}
    assert lit == {"mysql:a": ("NULL", False), "mysql:b": ("NULL", False)}


def test_store_namespace_views_and_lists(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store3"))
    p1 = write_dump(FX.dump_lines(spark, SF), str(tmp_path / "f1"))
    store.stage(stage_dump(scan_dump(spark, p1, 1), "s"))
    inc = tmp_path / "include.txt"
    inc.write_text("customer\n nation \n")
    exc = tmp_path / "exclude.txt"
    exc.write_text("customer\n")
    t1 = 1358644800
    assert store.publish_namespace("s", t1, exclude_file=str(exc)) == [("documents", "published"),
                                                                        ("nation", "published")]
    assert store.publish_namespace("s", t1, include_file=str(inc), exclude_file=str(exc)) == [
        ("customer", "published"), ("nation", "unchanged")]
    status = store.apply_views("s", t1)
    assert status == [("customer_nation", "created", None)]
    assert spark.table("s_customer_nation").count() == FX.read(spark, SF, "customer").count()


def test_views_unaliased_tables_and_views_over_views(spark):
    from tidemark.plans.read import apply_views
    spark.sql("select 1 as id, 'a' as customer").createOrReplaceTempView("vx_customer")
    spark.sql("select 1 as id, 'n' as name").createOrReplaceTempView("vx_nation")
    views = [("top", "select `mid`.`id` AS `id`,`mid`.`customer` AS `customer` from `mid` where (`mid`.`name` <> ' from `nation`')"),
             ("mid", "select `customer`.`id` AS `id`,`customer`.`customer` AS `customer`,`n`.`name` AS `name` "
                     "from (`customer` join `nation` `n` on((`customer`.`id` = `n`.`id`)))"),
             ("bad", "select `nope`.`x` AS `x` from `nope`"),
             ("x", "select `y`.`id` AS `id` from `y`"), ("y", "select `x`.`id` AS `id` from `x`")]
    status = apply_views(spark, views, "vx", ["customer", "nation"])
    assert [s[:2] for s in status] == [("top", "created"), ("mid", "created"), ("bad", "failed"), ("x", "failed"), ("y", "failed")]
    assert spark.table("vx_top").collect() == [(1, "a")]


def test_string_keys_keep_their_values(spark):
    from tidemark.operators.cells import chunk_cells
    from tidemark.plans.read import typed_asof
    df = spark.createDataFrame([("m", "('abc','x'),('7','y')")], "md5 string, payload string")
    h = chunk_cells(df, ["k", "v"]).withColumn("ts", F.lit(1).cast("long"))
    assert sorted(typed_asof(h, [("k", "string"), ("v", "string")]).collect()) == [("7", "y"), ("abc", "x")]


def test_store_parsetime_and_compact(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store4"))
    lines = FX.dump_lines(spark, SF)
    t1 = 1358644800
    for i in range(3):  # three dumps, nation 3 renamed each day
        li = lines.withColumn("value", F.regexp_replace("value", "NATION_3'", f"NATION_{i}x'")).withColumn(
            "value", F.regexp_replace("value", "2013-01-20", f"2013-01-2{i}"))
        store.stage(stage_dump(scan_dump(spark, write_dump(li, str(tmp_path / f"c{i}")), i), "s"))
        store.publish("s", "nation", t1 + i * 86400)
    assert store.read("stage_meta").filter(F.col("parsetime") >= 0).count() == 3
    cell = (F.col("row_id") == 3) & (F.col("column") == "mysql:n_name")
    assert store.history().filter(cell).count() == 3
    assert store.publish("s", "nation", t1, force=True).status == "rebuilt"  # a forced dump rebuilds the table
    assert store.history().filter(cell).count() == 3 and store.read("publish_log").count() == 3
    store.compact("s", "nation", 2)
    assert sorted(r["value"] for r in store.history().filter(cell).collect()) == ["NATION_1x", "NATION_2x"]
    assert store.read_asof("s", "nation").count() == 25


def test_arity_mismatch_raises(spark):
    from tidemark.operators.cells import chunk_cells
    df = spark.createDataFrame([("m", "(1,'a'),(2,'b','c')")], "md5 string, payload string")
    with pytest.raises(Exception, match="Mismatching"):
        chunk_cells(df, ["id", "a"]).collect()


def test_rebuild_with_deletes_equals_in_order_publish(spark, staged):
    from tidemark.plans.publish import publish_sequence_with_deletes
    from tidemark.plans.rebuild import rebuild_with_deletes
    h1, t1, _ = publish_sequence_with_deletes(spark, staged, NS, TBL, [100, 200, 300, 400, 500])
    h2, t2 = rebuild_with_deletes(staged, NS, TBL, FX.ORD_COLUMNS)
    hc = ["row_key", "column", "ts", "value"]
    assert sorted(tuple(r) for r in h1.select(*hc).collect()) == sorted(tuple(r) for r in h2.select(*hc).collect())
    tc = ["row_key", "ts"]
    assert sorted(tuple(r) for r in t1.select(*tc).collect()) == sorted(tuple(r) for r in t2.select(*tc).collect())
    for d in (100, 300, 400, 500):
        assert _read_masked(h2, t2, d) == _snapshot_cells(spark, d)


def test_rebuild_after_alter_names_columns_by_each_dump(spark, tmp_path):
    """A column added, then two reordered: every dump's rows are named by its own CREATE."""
    from tidemark.plans.publish import Staged
    from tidemark.plans.rebuild import rebuild_history
    chunks = [("m1", "(1,'a'),(2,'b')"), ("m2", "(1,'a','x'),(2,'c','y')"), ("m3", "(1,'x','a'),(2,'z','c')")]
    c = spark.createDataFrame([("n", "t", m, p) for m, p in chunks], "namespace string, tbl_name string, md5 string, payload string")
    m = spark.createDataFrame([("n", d, "t", 0, k) for d, k in ((10, "m1"), (20, "m2"), (30, "m3"))],
                              "namespace string, dump_ts long, tbl_name string, seq int, md5 string")
    ddl = spark.createDataFrame([], "namespace string, dump_ts long, name string, stmt string")
    names = {10: ["id", "p"], 20: ["id", "p", "q"], 30: ["id", "q", "p"]}
    got = sorted((r["ts"], r["row_id"], r["column"], r["value"]) for r in rebuild_history(Staged(m, c, ddl), "n", "t", names).collect())
    assert got == [(10, 1, "mysql:p", "a"), (10, 2, "mysql:p", "b"), (20, 1, "mysql:q", "x"), (20, 2, "mysql:p", "c"),
                   (20, 2, "mysql:q", "y"), (30, 2, "mysql:q", "z")]
