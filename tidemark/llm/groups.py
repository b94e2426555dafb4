"""Connected components of an edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, materialize


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the edges of a batch: at most one (node, smallest node) edge per node leaves it."""
    for b in batches:
        u, v = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if not len(u):
            continue
        nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = union(len(nodes), at[:len(u)].tolist(), at[len(u):].tolist())
        own = np.flatnonzero(root != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(nodes[root[own]])], names=["u", "v"])


def union(n: int, a: list[int], b: list[int]) -> np.ndarray:
    """Root (smallest member) of each of n nodes after joining a[i] with b[i]; union-find with path halving."""
    up = list(range(n))
    for x, y in zip(a, b):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        while up[y] != y:
            up[y] = up[up[y]]
            y = up[y]
        if x < y:
            up[y] = x
        elif y < x:
            up[x] = y
    for x in range(n):  # parents are smaller, so one pass in order resolves every root
        up[x] = up[up[x]]
    return np.asarray(up, dtype=np.int64)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): smallest node reachable, for every node of ``edges`` (two long columns, any names).

    Edges are first reduced to forests inside each batch, then large-star and small-star steps run until every node
    points at its smallest reachable node. The minimum of a node's neighbours is a partial aggregate, so a hub is
    never gathered in one task; each step is materialised in the shared folder. Self-loops keep a lone node.
    """
    a, b = edges.columns
    e = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u is not null and v is not null")
    lone = e.where("u = v").select("u")
    e = materialize(map_arrow(e.where("u <> v"), _forest, "u long, v long").distinct())
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # after large-star every edge points to a smaller node: small-star links the smaller neighbours of u
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                            F.col("m").alias("v")).where("u <> v").distinct()
        new = materialize(small)
        left = new.select("v").distinct().join(new.select(F.col("u").alias("v")).distinct(), "v", "left_semi")
        parents = new.groupBy("u").agg(F.count("*").alias("n")).where("n > 1")
        e = new
        if left.isEmpty() and parents.isEmpty():
            break
    roots = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    full = e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
    alone = lone.distinct().join(full, lone["u"] == full["node"], "left_anti").select(
        F.col("u").alias("node"), F.col("u").alias("component"))
    return full.unionAll(alone)
