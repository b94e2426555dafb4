"""Range join by ranks, as-of baselines and paged hash lists against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import milestones as M
from tidemark.operators.diff import range_join
from tidemark.plans.catalog import hash_pages


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_range_join_equals_brute_force(spark, block):
    rnd = random.Random(block)
    ids = [1, 10**15, -(2**63), 2**63 - 1, *(rnd.randrange(-300, 300) for _ in range(120)), *(rnd.randrange(10**12) for _ in range(30))]
    ranges = [("far", 1, 10**15), ("all", -(2**63), 2**63 - 1), ("one", 7, 7), ("none", 10**13, 10**14), ("back", 5, 4), ("null", None, 9)]
    ranges += [(f"r{i}", a, a + rnd.randrange(200)) for i, a in enumerate(rnd.randrange(-300, 300) for _ in range(40))]
    k = spark.createDataFrame([(i, f"k{n}") for n, i in enumerate(ids)] + [(None, "null")], "row_id long, row_key string").repartition(5)
    r = spark.createDataFrame(ranges, "md5 string, first_id long, last_id long")
    got = sorted((x.md5, x.row_key) for x in range_join(r, k, block).collect())
    want = sorted((m, f"k{n}") for m, a, b in ranges if a is not None for n, i in enumerate(ids) if a <= i <= b)
    assert got == want


def test_range_join_of_empty_sides(spark):
    k = spark.createDataFrame([], "row_id long, row_key string")
    r = spark.createDataFrame([("m", 1, 5)], "md5 string, first_id long, last_id long")
    assert range_join(r, k).count() == 0
    assert range_join(r.limit(0), spark.createDataFrame([(1, "a")], "row_id long, row_key string")).count() == 0


def test_baselines_of_many_dumps(spark):
    """Ten thousand dumps, every third published: each sees the last publish before it."""
    n = 10_000
    m = spark.range(n).select(F.lit("n").alias("namespace"), F.lit("t").alias("tbl_name"), (F.col("id") * 10).alias("dump_ts"),
                              F.lit(0).alias("seq"), F.col("id").cast("string").alias("md5"))
    log = spark.range(0, n, 3).select(F.lit("n").alias("namespace"), F.lit("t").alias("tbl_name"), (F.col("id") * 10).alias("dump_ts"))
    got = {r.dump_ts: r.baseline_ts for r in M.chunks_since(m, log).collect()}
    assert got == {d * 10: (d - 1) // 3 * 30 if d > 0 else None for d in range(n)}


def test_pages_keep_the_order(spark):
    rows = [("n", 1, t, s * 7, f"{t}{s}") for t in "ab" for s in range(25)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "namespace string, dump_ts long, tbl_name string, seq long, md5 string").repartition(4)
    got = {(r.tbl_name, r.page): r.hashes for r in hash_pages(df, 10).collect()}
    assert got == {(t, p): [f"{t}{s}" for s in range(25)][p * 10:p * 10 + 10] for t in "ab" for p in range(3)}
