"""The store on small random tables: commits, bases against plain reads, pruning, drops, modes."""

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.operators import history as H
from tidemark.plans import publish as P
from tidemark.plans.stage import StagedDump
from tidemark.plans.store import Store

DDL = "(`a` int(11) NOT NULL,`b` varchar(9) NOT NULL,`x` varchar(9),`y` int(11),PRIMARY KEY (`b`,`a`)) ENGINE=x"


def run_of(spark, when, rows, tbl="t", view=None, chunk=4):
    """Staging run of one dump: rows (a, b, x, y) in chunks by a."""
    import hashlib
    show = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else f"'{v}'"
    chunks = {}
    for r in sorted(rows):
        chunks.setdefault(r[0] // chunk, []).append("(" + ",".join(map(show, r)) + ")")
    c = [("n", tbl, hashlib.md5(",".join(v).encode()).hexdigest(), ",".join(v)) for v in chunks.values()]
    m = [("n", when, tbl, i, x[2]) for i, x in enumerate(c)]
    ddl = [("n", when, tbl, DDL)]
    frame = lambda rows, schema: spark.createDataFrame(rows, schema).coalesce(1)
    return StagedDump(frame(c, "namespace string, tbl_name string, md5 string, payload string"),
                      frame(m, "namespace string, dump_ts long, tbl_name string, seq long, md5 string"),
                      frame(ddl, "namespace string, dump_ts long, name string, stmt string"),
                      frame([("n", when, view, "select 1")] if view else [], "namespace string, dump_ts long, name string, stmt string"),
                      frame([("n", when, "staged", len(m), "")], "namespace string, dump_ts long, status string, rowcount long, md5 string"))


def read(store, when, tbl="t"):
    return sorted((r["a"], r["b"], r["x"], r["y"]) for r in store.read_asof("n", tbl, when).collect())


def test_a_run_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "s"))
    store.stage(run_of(spark, 10, [(1, "k", "v", 1), (9, "k", "v", 2)], view="w"))
    before = {n: sorted(map(str, store.read(n).collect())) for n in ("stage_manifest", "stage_views", "stage_chunks", "stage_meta")}
    with monkeypatch.context() as m:
        m.setattr(Store, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.stage(run_of(spark, 10, [(1, "k", "new", 1)]))
        with pytest.raises(RuntimeError):
            store.stage(run_of(spark, 20, [(1, "k", "new", 1)]))
    assert {n: sorted(map(str, store.read(n).collect())) for n in before} == before
    store.stage(run_of(spark, 10, [(1, "k", "new", 1), (9, "k", "v", 2)]))  # again, without the view
    assert store.read("stage_views").count() == 0 and store.read("stage_meta").count() == 1
    m = store.read("stage_manifest").orderBy("seq").collect()
    assert len(m) == 2 and m[0]["first_stage"] != m[1]["first_stage"]  # the unchanged chunk stays where it was
    assert store.read("stage_chunks").count() == 3
    assert store.vacuum() >= 3
    store.publish("n", "t", 10)
    assert read(store, 10) == [(1, "k", "new", 1), (9, "k", "v", 2)]
    assert store.chunk("n", "t", m[1]["md5"]).collect()[0]["payload"] == "(9,'k','v',2)"
    assert store.vacuum() == 0


def test_a_publish_without_its_log_row_is_not_seen(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "s"))
    store.stage(run_of(spark, 10, [(1, "k", "v", 1)]))
    with monkeypatch.context() as m:
        m.setattr(Store, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.publish("n", "t", 10)
    assert store.history().count() == 0 and store.published("n", "t") == []
    with pytest.raises(ValueError, match="not published"):
        store.read_asof("n", "t", 10)
    assert store.publish("n", "t", 10).status == "published"
    assert read(store, 10) == [(1, "k", "v", 1)] and store.history().count() == 4


def test_drop_touches_one_table(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    for t in ("t", "u"):
        store.stage(run_of(spark, 10 if t == "t" else 20, [(1, "k", t, 1)], tbl=t))
        store.publish("n", t, 10 if t == "t" else 20)
    kept = sorted(p for p in (tmp_path / "s" / "publish_log").rglob("*.parquet") if "tbl_name=u" in str(p))
    store.drop("n", "t")
    assert store.published("n", "t") == [] and store.published("n", "u") == [20]
    assert sorted((tmp_path / "s" / "publish_log").rglob("*.parquet")) == kept
    assert read(store, 20, "u") == [(1, "k", "u", 1)]


def test_force_keeps_the_mode(spark, tmp_path):
    """A literal publish loses new rows in a chunk that had rows; a forced one must lose them again."""
    store = Store(spark, str(tmp_path / "s"))
    store.stage(run_of(spark, 10, [(1, "k", "v", 1)]))
    store.stage(run_of(spark, 20, [(1, "k", "w", 1), (2, "k", "new", 2)]))
    for d in (10, 20):
        store.publish("n", "t", d, mode="literal")
    cells = lambda: sorted(map(str, store.history("n", "t").select("row_key", "column", "ts", "value").collect()))
    once = cells()
    assert not any("new" in c for c in once)
    assert store.publish("n", "t", 20, force=True).status == "rebuilt"
    assert cells() == once and {r["mode"] for r in store.log("n", "t")} == {"literal"}


@pytest.mark.parametrize("seed", [1])
def test_bases_never_change_a_read(spark, tmp_path, seed):
    """Random dumps published in a random order with deletes, bases of random times in between (also later than dumps still to
    come): reading as of any published dump gives that dump, with and without bases."""
    rnd = random.Random(seed)
    dumps, rows = {}, {}
    for when in (10, 20, 30, 40):
        for _ in range(7):
            k = (rnd.randrange(12), rnd.choice(["k", "07", "7"]))
            if rnd.random() < 0.3:
                rows.pop(k, None)
            else:
                rows[k] = (rnd.choice("pqr"), rnd.choice([None, 1, 2]))
        dumps[when] = sorted((*k, *v) for k, v in rows.items())
    store = Store(spark, str(tmp_path / "s"))
    for when, r in dumps.items():
        store.stage(run_of(spark, when, r))
    order = rnd.sample(list(dumps), len(dumps))
    done = []
    for i, when in enumerate(order):
        store.publish("n", "t", when, apply_deletes=True)
        done.append(when)
        if i < 3:
            store.build_base("n", "t", rnd.choice([d for d in (5, 10, 15, 25, 30, 45) if d >= min(done)] or [45]))
    for when in dumps:
        at = store.asof("n", "t", when)
        assert at.base is None or (at.base["base_ts"] <= when and len(at.increments) <= 4)
        assert read(store, when) == dumps[when], (order, when)
    with_bases = {t: read(store, t) for t in (12, 25, 35, 99)}
    assert any(store.asof("n", "t", t).base for t in with_bases)
    store.drop_bases("n", "t")
    assert {t: read(store, t) for t in with_bases} == with_bases


def test_a_read_opens_one_base_and_what_it_lacks(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    for when in (10, 20, 30):
        store.stage(run_of(spark, when, [(i, "k", f"v{when if i == 1 else 0}", 1) for i in range(8)]))
        store.publish("n", "t", when)
        if when == 20:
            store.build_base("n", "t", 20)
    at = store.asof("n", "t", 30)
    assert at.base["base_ts"] == 20 and at.increments == [30]
    files = [r[0].split("/s/")[1].rsplit("/", 1)[0] for r in at.cells.select(F.input_file_name()).distinct().collect()]
    assert {f for f in files if f.startswith("history")} == {"history/namespace=n/tbl_name=t/publish_id=30"}
    assert [f for f in files if f.startswith("bases")] == [f"bases/namespace=n/tbl_name=t/base_id={at.base['base_id']}"]
    assert store.asof("n", "t", 15).base is None


def test_files_hold_narrow_row_ranges(spark, tmp_path):
    from tidemark.plans.store import clustered
    df = spark.range(10_000).select((F.col("id") * 7919 % 10_000).alias("row_id"), F.lit("k").alias("row_key"), F.lit("c").alias("column"),
                                    F.lit(1).alias("ts"), F.lit("n").alias("p")).repartition(7)
    clustered(df, ["p"], 1500).write.partitionBy("p").parquet(str(tmp_path / "c"))
    spans = []
    for f in (tmp_path / "c").rglob("*.parquet"):
        ids = pq.ParquetFile(f).read(columns=["row_id"]).column("row_id").to_pylist()
        assert ids == sorted(ids)
        spans.append((ids[0], ids[-1]))
    spans.sort()
    assert len(spans) == 7 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_plans_prune_and_exchange_once(spark, tmp_path, capsys):
    store = Store(spark, str(tmp_path / "s"))
    for when in (10, 20):
        store.stage(run_of(spark, when, [(i, "k", f"v{when if i == 1 else 0}", 1) for i in range(8)]))
    m = store.read("stage_manifest")
    new = m.filter("dump_ts = 20").join(m.filter("dump_ts = 10").select("md5"), "md5", "left_anti").select("md5", "first_stage", "seq")
    P._wanted(store.staged().chunks, new)[0].explain("formatted")
    plan = capsys.readouterr().out
    scan = plan[plan.index("stage_chunks"):]
    assert "first_stage" in scan[scan.index("PartitionFilters"):].split("\n")[0]
    assert "md5" in scan[scan.index("PushedFilters"):].split("\n")[0]
    c = spark.range(100).selectExpr("cast(id as string) row_key", "id row_id", "'c' column", "id ts", "'v' value", "false is_null")
    t = c.selectExpr("row_key", "cast(null as string) column", "ts + 1 as ts")
    for df in (H.masked_asof(c, t, 50), H.mask_tombstones(c, t, 50), H.asof_wide(c, ["c"], 50, tombstones=t)):
        df.explain()
        assert capsys.readouterr().out.count("Exchange hashpartitioning") == 1


def test_many_tables_in_one_plan(spark, tmp_path):
    """Eight tables of two shapes: the same reads as table by table, deletes included, in as many jobs as one table takes."""
    rnd = random.Random(7)
    many, single = Store(spark, str(tmp_path / "m")), Store(spark, str(tmp_path / "s"))
    names = [f"t{i}" for i in range(8)]
    dumps = {t: {w: [(a, rnd.choice("kl"), rnd.choice("pqr"), w + rnd.randrange(2)) for a in rnd.sample(range(9), 6)] for w in (10, 20)} for t in names}

    def runs(when, tables):
        parts = [run_of(spark, when, dumps[t][when], tbl=t) for t in tables]
        both = lambda f: __import__("functools").reduce(lambda a, b: a.unionByName(b), [getattr(p, f) for p in parts])
        return StagedDump(both("chunks"), both("manifest"), both("ddl"), both("views"), both("meta").limit(1))

    jobs = {}
    for store, tables in ((many, names), (single, names[:1])):
        for when in (10, 20):
            store.stage(runs(when, tables))
            spark.sparkContext.setJobGroup(f"{len(tables)}-{when}", "publish")
            got = store.publish_namespace("n", when, apply_deletes=True)
            assert got == [(t, "published") for t in tables]
            jobs[len(tables), when] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"{len(tables)}-{when}"))
            spark.sparkContext.setJobGroup("other", "")
    assert store.publish_namespace("n", 20) == [("t0", "unchanged")]
    for t in names:
        for when in (10, 20):
            assert read(many, when, t) == sorted(dumps[t][when])
    for when in (10, 20):
        assert jobs[8, when] <= jobs[1, when] + 4, jobs
