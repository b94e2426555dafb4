"""Metric range join against brute force, with blocks and chunks small enough that pairs meet across tiles."""

import math
import random

import numpy as np
import pytest

from tidemark.llm import metricjoin as M


def brute(rows, threshold):
    """(n_links, component) per position: exact sums over all pairs."""
    ok = [r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    width = max((len(r[1]) for r in rows if r[1]), default=0)
    v = [[*map(float, r[1]), *[0.0] * (width - len(r[1]))] if k else None for r, k in zip(rows, ok)]
    v = [[x / max(map(abs, e)) for x in e] if e else e for e in v]  # a cosine does not change
    dot = lambda a, b: math.fsum(x * y for x, y in zip(a, b))
    n = len(rows)
    count = [0] * n
    up = {r[0]: r[0] for r in rows if r[0] is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and dot(v[i], v[j]) / math.sqrt(dot(v[i], v[i]) * dot(v[j], v[j])) >= threshold:
                count[i] += 1
                count[j] += 1
                a, b = find(rows[i][0]), find(rows[j][0])
                up[max(a, b)] = min(a, b)
    return sorted(((rows[i][0], count[i], None if rows[i][0] is None else find(rows[i][0])) for i in range(n)), key=str)


def run(spark, rows, threshold=0.9, kind="double", **sizes):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], f"vec_id long, embedding array<{kind}>, uid string, block int")
    got = M.range_join(df, threshold, **sizes).collect()
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str)


def clustered(n, dims, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    out = []
    for i in range(n):
        c = centres[0] if i % 3 == 0 else centres[rng.integers(6)]
        out.append((int(i * 7 % n), (c * rng.uniform(0.5, 3) + rng.normal(size=dims) * rng.choice([0, 0.1, 0.25, 0.6])).tolist()))
    return out


@pytest.mark.parametrize("threshold", [0.6, 0.9, 0.99])
def test_equals_brute_force_over_many_tiles(spark, threshold):
    rows = clustered(260, 6, 3)
    assert run(spark, rows, threshold, block=16, chunk=20, small=30) == brute(rows, threshold)


def test_awkward_rows(spark):
    rows = [(5, [1.0, 0.0]), (3, [2.0, 0.0]), (3, [0.0, 1.0]), (9, [0.0, 3.0]), (1, None), (2, []), (4, [0.0, 0.0]), (6, [float("nan"), 1.0]),
            (7, [None, 1.0]), (None, [1.0, 0.0]), (8, [float("inf"), 0.0]), (10, [1.0]), (10, [1.0]), (11, [-0.0, -1.0]), (12, [1e300, 1e300]),
            (13, [1e-300, 1e-300])]
    assert run(spark, rows) == brute(rows, 0.9)
    assert run(spark, [(1, None)]) == [(1, 0, 1)]
    assert run(spark, rows[:0]) == []


def test_ties_at_the_threshold(spark):
    rows = [(1, [3.0, 1.0, 0.0]), (2, [3.0, 0.0, 1.0]), (3, [3.0, 0.0, 1.0]), (4, [6.0, 2.0, 0.0])]  # cosine 9 / 10
    assert run(spark, rows, kind="float") == [(1, 3, 1), (2, 3, 1), (3, 3, 1), (4, 3, 1)]
    assert run(spark, rows, 0.9000001) == [(1, 1, 1), (2, 1, 2), (3, 1, 2), (4, 1, 1)]


def test_hot_copies_and_long_vectors(spark):
    random.seed(2)
    hot = [random.gauss(0, 1) for _ in range(700)]
    rows = [(i, hot) for i in range(300)] + [(i, [x + random.gauss(0, 0.3) for x in hot]) for i in range(300, 320)]
    rows += [(i, [random.gauss(0, 1) for _ in range(700)]) for i in range(320, 340)]
    assert run(spark, rows, kind="float", block=8, chunk=8, small=8) == run(spark, rows, kind="float")
    got = dict((i, (n, c)) for i, n, c in run(spark, rows))
    assert got[0] == (319, 0) and got[310] == (319, 0) and got[330] == (0, 330)


def test_layout_never_separates_a_pair():
    """Any two linked rows share a block, or one is a replica in the other's block; and only one of them."""
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(40, 5)), 10, axis=0) + rng.normal(size=(400, 5)) * 0.3
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    r = math.acos(0.9)
    pivots = M.choose_pivots(unit[::5], 12, math.cos(2 * r))
    assert ((pivots @ pivots.T)[~np.eye(len(pivots), dtype=bool)] < math.cos(2 * r)).all()
    _, cell, bucket = M.Layout(pivots, [], r).place(unit)
    counts: dict = {}
    for k in zip(cell.tolist(), bucket.tolist()):
        counts[k] = counts.get(k, 0) + 1
    lay = M.Layout(pivots, M.rings_of(counts, 9), r)
    own, i, to = lay.route(unit, np.arange(400, dtype=np.uint64))
    assert np.bincount(own).max() <= 40 and len(np.unique(own)) > 40
    sent = set(zip(i.tolist(), to.tolist()))
    a, b = np.nonzero(np.triu(unit @ unit.T >= 0.9, 1))
    for p, q in zip(a.tolist(), b.tolist()):
        meets = ((p, own[q]) in sent) + ((q, own[p]) in sent)
        assert meets == (own[p] != own[q])
