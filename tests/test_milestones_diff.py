"""Worked examples: milestones (W1-W3, U5) and the snapshot diff in both modes."""

from pyspark.sql import functions as F

from tidemark.operators import diff as D
from tidemark.operators import history as H
from tidemark.operators import milestones as M

DUMPS = {100: ["h1", "h2"], 200: ["h1", "h2"], 300: ["h1", "h3"], 400: ["h1"], 500: ["h3", "h1"]}


def _manifest(spark):
    rows = [("ns", "t", ts, i, h) for ts, hs in DUMPS.items() for i, h in enumerate(hs)]
    return spark.createDataFrame(rows, "namespace string, tbl_name string, dump_ts long, seq long, md5 string")


def test_milestones(spark):
    m = _manifest(spark)
    new = {}
    for r in M.new_chunks(m).collect():
        new.setdefault(r["dump_ts"], set()).add(r["md5"])
    assert new == {100: {"h1", "h2"}, 300: {"h3"}, 500: {"h3"}}
    b = {r["dump_ts"]: (r["prev_ts"], r["next_ts"]) for r in M.milestone_bounds(m, 999).collect()}
    assert b == {100: (0, 300), 300: (100, 500), 500: (300, 999)}
    rem = {(r["dump_ts"], r["md5"]) for r in M.removed_chunks(m).collect()}
    assert rem == {(300, "h2"), (400, "h3")}
    ch = {r["dump_ts"]: r["changed"] for r in M.manifest_changed(m).collect()}
    assert ch == {100: True, 200: False, 300: True, 400: True, 500: True}


def test_chunks_since_published(spark):
    m = _manifest(spark)
    log = spark.createDataFrame([("ns", "t", 100), ("ns", "t", 500)], "namespace string, tbl_name string, dump_ts long")
    got = {(r["dump_ts"], r["md5"]) for r in M.chunks_since(m, log).collect()}
    assert got == {(100, "h1"), (100, "h2"), (300, "h3"), (500, "h3")}


def _hist(spark, rows):
    return spark.createDataFrame([(str(k), k, f"mysql:{c}", ts, v, False) for k, c, ts, v in rows],
                                 "row_key string, row_id long, column string, ts long, value string, is_null boolean")


def _incoming(spark, rows):
    return spark.createDataFrame([("m", str(k), k, f"mysql:{c}", v, False) for k, c, v in rows],
                                 "md5 string, row_key string, row_id long, column string, value string, "
                                 "is_null boolean")


def _row(k, a, b):
    return [(k, "c1", a), (k, "c2", b)]


HISTORY = [(k, c, 100, v) for k in (1, 2, 3) for c, v in (("c1", "a"), ("c2", "b"))] + [
    (1, "c1", 300, "z"), (4, "c1", 300, "n"), (4, "c2", 300, "n")]
INCOMING = _row(1, "x", "b") + _row(2, "a", "b") + _row(4, "n", "n") + _row(5, "p", "q")


def _writes(d):
    out = {}
    for r in d.writes.collect():
        out.setdefault(r["row_id"], {})[r["column"].split(":")[1]] = r["value"]
    return out


def _run(spark, history, incoming, mode):
    h = _hist(spark, history)
    inc = _incoming(spark, incoming)
    prev, nxt = H.asof(h, 100), H.asof(h, 300)
    pic = D.range_join(spark.createDataFrame([("m", 1, 5)], "md5 string, first_id long, last_id long"),
                       prev.select("row_key", "row_id").distinct()).select("md5", "row_key", "row_id")
    removed = prev.select(F.lit("old").alias("md5"), "row_key", "row_id").distinct()
    return D.diff(inc, prev, nxt, 200, 300, mode, removed_keys=removed, prev_in_chunk=pic)


def test_diff_worked_example_corrected(spark):
    d = _run(spark, HISTORY, INCOMING, "corrected")
    assert _writes(d) == {1: {"c1": "x"}, 4: {"c1": "n", "c2": "n"}, 5: {"c1": "p", "c2": "q"}}
    assert [(r["ts"], r["row_id"], r["column"]) for r in d.deletes.collect()] == [(200, 3, None)]
    assert [(r["ts"], r["row_id"], r["column"]) for r in d.redundant.collect()] == [(300, 4, None)]
    assert d.restores.count() == 0


def test_diff_worked_example_literal(spark):
    d = _run(spark, HISTORY, INCOMING, "literal")
    assert _writes(d) == {1: {"c1": "x"}}
    assert [(r["ts"], r["row_id"], r["column"]) for r in d.deletes.collect()] == [(200, 3, None)]
    assert [(r["ts"], r["row_id"], r["column"]) for r in d.redundant.collect()] == [(300, 4, None)]


def test_diff_empty_prev(spark):
    hist = [(4, "c1", 300, "n"), (4, "c2", 300, "n")]
    lit = _run(spark, hist, INCOMING, "literal")
    cor = _run(spark, hist, INCOMING, "corrected")
    assert sorted(_writes(lit)) == [1, 2, 5]
    assert sorted(_writes(cor)) == [1, 2, 4, 5]
    for d in (lit, cor):
        assert [(r["ts"], r["row_id"], r["column"]) for r in d.redundant.collect()] == [(300, 4, None)]


def test_diff_restore(spark):
    hist = HISTORY
    inc = _row(1, "x", "b") + _row(2, "q", "b") + _row(4, "n", "n") + _row(5, "p", "q")
    cor = _run(spark, hist, inc, "corrected")
    assert _writes(cor)[2] == {"c1": "q"}
    assert [(r["ts"], r["row_id"], r["column"], r["value"]) for r in cor.restores.collect()] == [
        (300, 2, "mysql:c1", "a")]
    lit = _run(spark, hist, inc, "literal")
    assert lit.restores.count() == 0


def test_tagged_union(spark):
    d = _run(spark, HISTORY, INCOMING, "corrected")
    kinds = {r["change_kind"]: r["n"] for r in d.tagged().groupBy("change_kind").agg(F.count("*").alias("n")).collect()}
    assert kinds == {"write": 5, "delete": 1, "redundant": 1}


def test_range_join_buckets(spark):
    ranges = spark.createDataFrame([("a", 10, 200000), ("b", 300000, 300001)], "md5 string, first_id long, last_id long")
    keys = spark.createDataFrame([(str(i), i) for i in (9, 10, 70000, 200000, 200001, 300001)],
                                 "row_key string, row_id long")
    got = sorted((r["md5"], r["row_id"]) for r in D.range_join(ranges, keys).collect())
    assert got == [("a", 10), ("a", 70000), ("a", 200000), ("b", 300001)]
