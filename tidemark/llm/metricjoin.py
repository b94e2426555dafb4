"""Exact metric range join over vectors: all pairs with a cosine of at least a threshold, as groups and link counts.

The angle between directions is a metric; two vectors are linked if their angle is at most ``r = arccos(threshold)``.

1. Rows with equal components are one *class* with a weight; only classes go on, so copies cost nothing more.
2. *Pivots* (at most ``PIVOTS``, taken from a sample of ``8 * PIVOTS`` classes at most, more than ``2 r`` apart) partition the
   classes: a class belongs to the cell of its nearest pivot. A cell is cut into *rings* by the angle to its pivot, and a
   ring of more than ``BLOCK`` classes by hash, so that no block is large, however many vectors are alike.
3. The triangle inequality says to which other blocks a class must be replicated: a member x of a ring ``[lo, hi)`` around
   p that is linked with y has ``lo - r <= angle(y, p) <= hi + r``; and as x is nearer to p than to y's own pivot o, y is
   at most r from the hyperplane between the two: ``cos(y, o) - cos(y, p) <= sin(r) * |o - p|``. Of two blocks one is the
   host of the pair (a rule on their numbers), so a pair meets once.
4. A *tile* is a block and a chunk of about ``CHUNK`` replicas. It holds the block, streams the chunk past it, adds up the
   weights of the links of each class and returns a spanning forest of them: nothing is emitted per pair.
5. Link counts are summed and the forests joined to components.

The pivots only decide where pairs meet; links are found by inner products in double precision, and those within 1e-12
of the threshold are decided by exactly rounded sums. Data without any cluster structure (the angles to all pivots nearly
equal) gain little from the inequality: then a class reaches about half of the blocks, whose number is n / BLOCK.

Defined results: a vector that is null, empty, zero or holds null or non-finite components links with nothing, nor does a
row without id; it is its own component (null for a null id). Shorter vectors count as padded with zeros. Rows that
repeat an id are vectors of their own, linked with each other if similar; if they are not, their component is still one,
because components are sets of ids. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, materialize, partitions
from .groups import components

PIVOTS = 1024  # broadcast bound: PIVOTS x dimensions x 8 bytes
BLOCK, CHUNK = 32_768, 524_288
SMALL = 2048  # small inputs still get up to 16 cells of about this size, for parallel work
BUCKETS = 200  # angle buckets over [0, pi] from which rings are made
SLACK = 1e-7  # of the pruning bounds, far above rounding errors
TIE = 1e-12


def packed(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(uid, id, s1, s2, v): the components as bytes (null: takes no part) and a 128-bit digest of them."""
    single = "float" in vectors.schema[vector].dataType.simpleString()
    kind = np.dtype("<f4" if single else "<f8")
    rows = vectors.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("id"),
                          F.col(vector).cast("array<float>" if single else "array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col, ids = b.column(2), b.column(1)
            off = col.offsets.to_numpy()
            flat = col.values
            x = flat.fill_null(math.nan).to_numpy(zero_copy_only=False).astype(kind) + kind.type(0)  # -0.0 becomes 0.0
            there, known = col.is_valid().to_pylist(), ids.is_valid().to_pylist()
            v: list[bytes | None] = []
            for i in range(b.num_rows):
                part = x[off[i]:off[i + 1]]
                v.append(part.tobytes() if there[i] and known[i] and np.isfinite(part).all() and part.any() else None)
            dig = [0 if e is None else xxhash.xxh3_128_intdigest(e) for e in v]
            half = [np.array([d >> s & (2**64 - 1) for d in dig], np.uint64).view(np.int64) for s in (0, 64)]
            yield pa.RecordBatch.from_arrays([b.column(0), ids, pa.array(half[0]), pa.array(half[1]), pa.array(v, pa.binary())],
                                             names=["uid", "id", "s1", "s2", "v"])

    return map_arrow(rows, run, "uid long, id long, s1 long, s2 long, v binary")


def matrix(column: list[bytes], kind: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(raw rows scaled by powers of two, unit rows) of packed vectors, padded with zeros to ``width``."""
    raw = np.zeros((len(column), width))
    size = np.dtype(kind).itemsize
    for i, e in enumerate(column):
        raw[i, :len(e) // size] = np.frombuffer(e, kind)
    _, power = np.frexp(np.abs(raw).max(axis=1, initial=0))
    raw = np.ldexp(raw, -power[:, None])
    return raw, raw / np.sqrt(np.einsum("ij,ij->i", raw, raw))[:, None]


def choose_pivots(sample: np.ndarray, count: int, cos_apart: float) -> np.ndarray:
    """Up to ``count`` rows of ``sample``, in order, each with a cosine under ``cos_apart`` to those before it."""
    chosen = [0]
    near = sample @ sample[0]
    for i in range(1, len(sample)):
        if len(chosen) == count:
            break
        if near[i] < cos_apart:
            chosen.append(i)
            near = np.maximum(near, sample @ sample[i])
    return sample[chosen]


def rings_of(counts: dict[tuple[int, int], int], block: int) -> list[tuple[int, int, int, int]]:
    """(cell, first bucket, end bucket, parts): consecutive angle buckets of a cell up to about ``block`` members."""
    out: list[tuple[int, int, int, int]] = []
    held = 0
    for (cell, bucket), n in sorted(counts.items()):
        if out and out[-1][0] == cell and held + n <= block:
            held += n
            out[-1] = (cell, out[-1][1], bucket + 1, 1)
        else:
            held = n
            out.append((cell, bucket, bucket + 1, -(-n // block)))
    return out


class Layout:
    """Where a class belongs and to which blocks it is replicated."""

    def __init__(self, pivots: np.ndarray, rings: list[tuple[int, int, int, int]], r: float):
        self.pivots, self.r = pivots, r
        self.apart = np.sqrt(np.maximum(0, 2 - 2 * (pivots @ pivots.T)))
        if not rings:
            return
        table = np.array(rings)
        self.cell, lo, hi, self.parts = table.T
        step = math.pi / BUCKETS
        self.lo, self.hi = lo * step - r - SLACK, hi * step + r + SLACK
        self.first = np.concatenate([[0], np.cumsum(self.parts)])
        self.blocks = int(self.first[-1])
        self.ring_of_block = np.repeat(np.arange(len(rings)), self.parts)
        self.ring = np.zeros((len(pivots), BUCKETS + 1), np.int64)  # of a cell and bucket
        for i, (c, a, b, _) in enumerate(rings):
            self.ring[c, a:b] = i

    def place(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cosines to the pivots, own cell, own bucket."""
        cos = np.clip(unit @ self.pivots.T, -1, 1)
        cell = cos.argmax(axis=1)
        angle = np.arccos(cos[np.arange(len(cos)), cell])
        return cos, cell, np.minimum((angle * (BUCKETS / math.pi)).astype(np.int64), BUCKETS)

    def route(self, unit: np.ndarray, uid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Own block of each row; (row, block) of its replicas."""
        cos, cell, bucket = self.place(unit)
        ring = self.ring[cell, bucket]
        own = self.first[ring] + (uid * 0x9E3779B97F4A7C15 >> np.uint64(33)).astype(np.int64) % self.parts[ring]
        here = cos[np.arange(len(cos)), cell]
        reach = here[:, None] - cos <= math.sin(self.r) * self.apart[cell] + SLACK if self.r < math.pi / 2 else np.ones(cos.shape, bool)
        angle = np.arccos(cos)[:, self.cell]
        reach = reach[:, self.cell] & (angle >= self.lo) & (angle <= self.hi)
        to = np.arange(self.blocks)[None, :]
        mine = own[:, None]
        host = np.where((to + mine) % 2 == 1, np.maximum(to, mine), np.minimum(to, mine))
        return own, *np.nonzero(reach[:, self.ring_of_block] & (host == to) & (to != mine))


def merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots (smallest member) after joining a[i] with b[i]; ``root`` is flat, and so is the result."""
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return root
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def exact(x: np.ndarray, y: np.ndarray) -> float:
    """Cosine from exactly rounded sums."""
    dot = lambda p, q: math.fsum((p * q).tolist())
    return dot(x, y) / math.sqrt(dot(x, x) * dot(y, y))


def linked(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], threshold: float,
           own: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of linked rows of x and y, slice by slice; with ``own`` (y is x) those with i < j."""
    for a in range(0, len(x[1]), 512):
        for b in range(a if own else 0, len(y[1]), 8192):
            s = x[1][a:a + 512] @ y[1][b:b + 8192].T
            i, j = np.nonzero(s >= threshold - TIE)
            if own:
                i, j = i[(up := i + a < j + b)], j[up]
            for t in np.flatnonzero(s[i, j] <= threshold + TIE)[::-1]:
                if exact(x[0][i[t] + a], y[0][j[t] + b]) < threshold:
                    i, j = np.delete(i, t), np.delete(j, t)
            if len(i):
                yield i + a, j + b


class Tile:
    """The block of one tile and what its links add up to."""

    def __init__(self, kind: str, width: int, threshold: float):
        self.kind, self.width, self.threshold = kind, width, threshold
        self.parts: list[pa.RecordBatch] = []
        self.ready = False

    def rows(self, b: pa.Table | pa.RecordBatch) -> tuple:
        num = lambda name: b.column(name).to_numpy()
        return num("uid"), num("low"), num("m"), matrix(b.column("v").to_pylist(), self.kind, self.width)

    def close(self, with_own: bool) -> None:
        self.ready = True
        self.uid, self.low, self.m, self.x = self.rows(pa.Table.from_batches(self.parts))
        self.parts = []
        self.root = np.arange(len(self.uid))
        self.sum = np.zeros(len(self.uid))
        if with_own:
            for i, j in linked(self.x, self.x, self.threshold, own=True):
                self.sum += np.bincount(i, self.m[j], len(self.sum)) + np.bincount(j, self.m[i], len(self.sum))
                self.root = merge(self.root, i, j)

    def replicas(self, b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        uid, low, m, x = self.rows(b)
        n = len(self.uid)
        total = np.zeros(len(uid))
        root = np.concatenate([self.root, np.arange(n, n + len(uid))])
        for i, j in linked(x, self.x, self.threshold):
            self.sum += np.bincount(j, m[i], n)
            total += np.bincount(i, self.m[j], len(uid))
            root = merge(root, i + n, j)
        self.root = root[:n]
        at = np.flatnonzero(total)
        yield out(uid[at], total[at], low[at], self.low[root[n + at]])

    def end(self) -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero(self.sum)
        yield out(self.uid[at], self.sum[at], self.low[at], self.low[self.root[at]])


def out(uid: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(uid), pa.array(n.astype(np.int64)), pa.array(a), pa.array(b)], names=["uid", "n", "a", "b"])


def range_join(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector: str = "embedding",
               block: int = BLOCK, chunk: int = CHUNK, small: int = SMALL) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links (other rows with a cosine of at least ``threshold``, which is over 0),
    component_id (smallest id reachable by links) and kept (vec_id = component_id)."""
    spark = vectors.sparkSession
    kind = "<f4" if "float" in vectors.schema[vector].dataType.simpleString() else "<f8"
    r = math.acos(threshold)
    rows = materialize(packed(vectors, id_col, vector))
    full = rows.where("v is not null")
    classes = materialize(full.groupBy("s1", "s2").agg(F.min("uid").alias("uid"), F.min("id").alias("low"),
                                                       F.count("*").alias("m"), F.any_value("v").alias("v")))
    n, most, width = classes.agg(F.count("*"), F.coalesce(F.max("m"), F.lit(0)), F.coalesce(F.max(F.length("v")), F.lit(0))).first()
    width //= np.dtype(kind).itemsize
    wanted = max(1, min(PIVOTS, max(-(-n // block), min(16, -(-n // small)))))
    sample = [x.v for x in classes.select("v").orderBy(F.xxhash64("v")).limit(8 * wanted).collect()]
    pivots = choose_pivots(matrix(sample, kind, width)[1], wanted, math.cos(min(math.pi, 2 * r))) if sample else np.zeros((1, width))

    plain = Layout(pivots, [], r)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, cell, bucket = plain.place(matrix(b.column(0).to_pylist(), kind, width)[1])
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(bucket)], names=["cell", "bucket"])

    # at most PIVOTS x (BUCKETS + 1) rows
    counts = map_arrow(classes.select("v"), placed, "cell long, bucket long").groupBy("cell", "bucket").count().collect()
    layout = Layout(pivots, rings_of({(c, b): k for c, b, k in counts}, block) or [(0, 0, 1, 1)], r)

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                own, i, to = layout.route(matrix(b.column("v").to_pylist(), kind, width)[1], b.column("uid").to_numpy().view(np.uint64))
                off = np.concatenate([[0], np.cumsum(np.bincount(i, minlength=b.num_rows))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own.astype(np.int32)), pa.ListArray.from_arrays(off, pa.array(to.astype(np.int32)))],
                                                 names=["uid", "low", "m", "v", "block", "to"])

    spread = materialize(map_arrow(classes.select("uid", "low", "m", "v"), routed, "uid long, low long, m long, v binary, block int, to array<int>"))
    copies = spread.select("uid", "low", "m", "v", F.explode("to").alias("block"))
    # one row per block, so about n / block rows
    size = F.broadcast(copies.groupBy("block").agg(F.ceil(F.count("*") / F.lit(chunk)).cast("int").alias("chunks")))
    tile = lambda c: F.col("block").cast("long") * F.lit(1 << 24) + c
    core = spread.join(size, "block", "left").select(
        "uid", "low", "m", "v", F.lit(0).alias("side"), "block",
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col("chunks"), F.lit(1)) - 1)).alias("chunk"))
    guests = copies.join(size, "block").select("uid", "low", "m", "v", F.lit(1).alias("side"), "block",
                                               F.pmod(F.xxhash64("uid"), F.col("chunks")).cast("int").alias("chunk"))
    tiles = core.unionAll(guests).select("uid", "low", "m", "v", "side", tile(F.col("chunk")).alias("tile"))
    tiles = tiles.repartition(max(partitions(tiles), layout.blocks), "tile").sortWithinPartitions("tile", "side")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Tile | None = None
        last = None
        for whole in batches:
            if not whole.num_rows:
                continue
            mark = whole.column("tile").to_numpy() * 2 + whole.column("side").to_numpy()
            cut = np.flatnonzero(np.diff(mark, prepend=mark[0] - 1)).tolist() + [len(mark)]
            for lo, hi in zip(cut, cut[1:]):
                at, side = divmod(int(mark[lo]), 2)
                if held is not None and at != last:
                    if not held.ready:
                        held.close(last % (1 << 24) == 0)
                    yield from held.end()
                    held = None
                held = held or Tile(kind, width, threshold)
                last = at
                if not side:
                    held.parts.append(whole.slice(lo, hi - lo))
                    continue
                if not held.ready:
                    held.close(at % (1 << 24) == 0)
                yield from held.replicas(whole.slice(lo, hi - lo))
        if held is not None:
            if not held.ready:
                held.close(last % (1 << 24) == 0)
            yield from held.end()

    found = materialize(map_arrow(tiles, search, "uid long, n long, a long, b long"))
    links = found.groupBy("uid").agg(F.sum("n").alias("n"))
    groups = components(found.where("a <> b").select("a", "b"))
    told = (classes.select("uid", "low", "m", "s1", "s2").join(links, "uid", "left")
            .join(groups.select(F.col("node").alias("low"), "component"), "low", "left")
            .select("uid", "s1", "s2", "m", (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "low").alias("component_id")))
    # a class with many rows is told to as many tasks as its share of the rows is worth
    total = full.count()
    salts = max(1, -(-most * partitions(rows) // max(1, total)))
    salt = F.pmod(F.col("uid"), F.lit(salts)).cast("int")
    every = F.when(F.col("m") > 1, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(salt))
    told = told.select("s1", "s2", F.explode(every).alias("salt"), "n_links", "component_id")
    known = full.select("id", "s1", "s2", salt.alias("salt")).join(told, ["s1", "s2", "salt"]).select("id", "n_links", "component_id")
    rest = rows.where("v is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return known.unionAll(rest).select(F.col("id").alias("vec_id"), "n_links", "component_id",
                                       F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op13(vectors: DataFrame) -> DataFrame:
    return range_join(vectors, 0.9)
