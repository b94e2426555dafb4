"""Near-duplicate groups by SuperMinHash signatures, banding, exact verification and union-find.

A document's set holds the hashes of its distinct five-word shingles (words ``[^\\x20\\x09-\\x0D]+`` after lower-casing
A-Z; with fewer words the whole sequence is one shingle). Two documents are linked if the exact Jaccard similarity of
their sets reaches the threshold; a group is a connected component of links.

1. One pass over the texts makes per document the set size, a 128-bit digest of the set and the band keys of its
   SuperMinHash signature. Equal sets are one *class*, represented by the smallest id; only representatives go on.
2. Documents that share a band key are linked to the key's smallest document; the components of these edges are the
   coarse clusters. Every pair that shares a band lies in one cluster, so no candidate pair is written out.
3. Inside a cluster sets are cut into size classes of ratio ``threshold``: similar sets lie in the same or in
   neighbouring classes. Classes are cut into blocks of ``BLOCK`` documents; a task verifies one pair of blocks with
   exact intersections (a matrix product over the shared shingles) and returns a spanning forest of its links.
4. The components of the verified links and of the classes are the result.

Bands: ``rows`` x ``bands`` is chosen so that a pair at the threshold is missed with a probability under 1e-6.

Defined results: null, empty or blank texts have an empty set, are linked with nothing and are their own component; a
null id is kept with a null component; rows repeating an id with the same text are one document each in the output
and one set in the work; rows repeating an id with different texts are linked through the id. Extra columns are
ignored. An empty table gives no rows. Long texts are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_key, map_arrow, materialize, texts
from .groups import components, union

BLOCK = 512
IDS_BROADCAST = 1_000_000  # longs: at most about 50 MB in an executor
WORDS_KEPT = 400_000  # distinct words whose hash a worker remembers
GOLD = 0x9E3779B97F4A7C15
ODD = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB],
               dtype=np.uint64)


class _Words(dict):
    """64-bit hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = _Words()


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * ODD[0]
    x = (x ^ (x >> np.uint64(27))) * ODD[1]
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles of a text."""
    words = text.lower().split()  # bytes: only A-Z and ASCII white space
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, n)
    if n < 5:
        return _mix(np.array([np.sum(w * ODD[:n]) + np.uint64(n)], np.uint64))
    s = w[: n - 4] * ODD[0]
    for k in range(1, 5):
        s += w[k: n - 4 + k] * ODD[k]
    return np.unique(_mix(s))


def superminhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash signatures (len(sets) x m, uint64: level << 32 | 32 random bits) of non-empty sets.

    Element e visits the positions of its own random permutation (Fisher-Yates, driven by a generator seeded with e);
    at its j-th step it offers the value j + r to a position, which keeps the minimum. Steps run level by level for
    all elements of a document and stop as soon as no position can still be lowered, that is, when every position
    holds a value of a lower level; most elements of long documents take one or two steps.
    """
    out = np.full((len(sets), m), np.uint64(0xFFFFFFFFFFFFFFFF))
    sizes = np.array([len(s) for s in sets])
    flat = out.reshape(-1)
    lo = 0
    while lo < len(sets):  # slices of about 2^16 elements bound the permutation state
        hi = lo + max(1, int(np.searchsorted(np.cumsum(sizes[lo:]), 1 << 16, "right")))
        e = np.concatenate(sets[lo:hi])
        doc = np.repeat(np.arange(lo, hi), sizes[lo:hi])
        perm = None
        for j in range(m):
            rnd = _mix(e + np.uint64(GOLD * (j + 1) % 2**64))
            k = (((rnd & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64) + j
            if j == 0:
                pos, first_k = k, k
            else:
                if perm is None:  # the state of the documents that go on after the first step
                    perm = np.broadcast_to(np.arange(m, dtype=np.uint16), (len(e), m)).copy()
                    perm[np.arange(len(e)), first_k] = 0
                    perm[:, 0] = first_k
                at = np.arange(len(e))
                pos = perm[at, k].astype(np.int64)
                perm[at, k] = perm[:, j]
                perm[:, j] = pos
            np.minimum.at(flat, doc * m + pos, (np.uint64(j) << np.uint64(32)) | (rnd >> np.uint64(32)))
            # a document is done when its largest value is of a level no later than this one
            open_ = out[lo:hi].max(axis=1) >> np.uint64(32) > np.uint64(j)
            on = open_[doc - lo]
            if not on.any():
                break
            if not on.all():
                e, doc = e[on], doc[on]
                first_k = first_k[on] if j == 0 else first_k
                perm = perm[on] if perm is not None else None
        lo = hi
    return out


def plan_bands(threshold: float, miss: float = 1e-6, most: int = 200) -> tuple[int, int]:
    """(rows, bands): the most rows a band with at most ``most`` positions and a miss rate under ``miss``."""
    for r in range(12, 0, -1):
        b = math.ceil(math.log(miss) / math.log(1 - threshold**r)) if threshold < 1 else 1
        if r * b <= most:
            return r, b
    raise ValueError(f"no banding for a threshold of {threshold}")


def signed(docs: DataFrame, rows: int, bands: int) -> DataFrame:
    """(id, n, s1, s2, bands): set size, digest of the set and band keys per row of (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = np.arange(bands, dtype=np.uint64) * np.uint64(GOLD)
        for b in batches:
            raw = texts(b.column(1))
            sets = [shingles(t) for t in raw]
            full = [i for i, s in enumerate(sets) if len(s)]
            keys = np.zeros((len(raw), bands), np.uint64)
            if full:
                sig = superminhash([sets[i] for i in full], rows * bands).reshape(len(full), bands, rows)
                k = np.broadcast_to(salt, (len(full), bands)).copy()
                for r in range(rows):
                    k = _mix(k ^ sig[:, :, r])
                keys[full] = k
            dig = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
            off = np.concatenate([[0], np.cumsum([bands if len(s) else 0 for s in sets])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(np.array([d & (2**64 - 1) for d in dig], np.uint64).view(np.int64)),
                pa.array(np.array([d >> 64 for d in dig], np.uint64).view(np.int64)),
                pa.ListArray.from_arrays(off, pa.array(keys[full].reshape(-1).view(np.int64), pa.int64()))],
                names=["id", "n", "s1", "s2", "bands"])

    return map_arrow(docs, run, "id long, n long, s1 long, s2 long, bands array<long>")


def links_of(sets_a: list[np.ndarray], sets_b: list[np.ndarray] | None, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) with den * |A_i & B_j| >= num * |A_i | B_j|; within one list (j < i) if sets_b is None."""
    every = sets_a + (sets_b or [])
    size = np.array([len(s) for s in every], np.int64)
    row = np.repeat(np.arange(len(every), dtype=np.int64), size)
    _, col, count = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    shared = count[col] > 1
    row, col = row[shared], col[shared]
    used, col = np.unique(col, return_inverse=True)
    na = len(sets_a)
    inter = np.zeros((na, na if sets_b is None else len(sets_b)), np.float32)  # exact: counts are under 2^24
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    width = max(256, (1 << 22) // max(1, len(every)))
    for c in range(0, len(used), width):
        lo, hi = np.searchsorted(col, [c, c + width])
        m = np.zeros((len(every), min(width, len(used) - c)), np.float32)
        m[row[lo:hi], col[lo:hi] - c] = 1
        inter += m[:na] @ (m[:na] if sets_b is None else m[na:]).T
    inter = np.rint(inter).astype(np.int64)
    sb = size[:na] if sets_b is None else size[na:]
    ok = (den + num) * inter >= num * (size[:na, None] + sb[None, :])
    if sets_b is None:
        ok &= np.tri(na, k=-1, dtype=bool)
    return np.nonzero(ok)


def verified(members: DataFrame, num: int, den: int) -> DataFrame:
    """Links (u, v) of (task, side, id, text) rows: a spanning forest of the links inside each task."""

    def run(group: pa.Table) -> Iterator[pa.RecordBatch]:
        ids = group.column("id").to_numpy()
        side = group.column("side").to_numpy()
        order = np.argsort(side, kind="stable")
        ids, na = ids[order], int((side == 0).sum())
        raw = group.column("text").to_pylist()
        sets = [shingles((raw[i] or "").encode()) for i in order]
        i, j = links_of(sets[:na], sets[na:] if na < len(sets) and na else None, num, den) if na else ([], [])
        if len(i) == 0:
            return
        a, b = i, j + (na if na < len(sets) else 0)
        root = union(len(ids), a.tolist(), b.tolist())
        own = np.flatnonzero(root != np.arange(len(ids)))
        yield pa.RecordBatch.from_arrays([pa.array(ids[own]), pa.array(ids[root[own]])], names=["u", "v"])

    return by_key(members, "task", run, "u long, v long")


def near_duplicates(docs: DataFrame, num: int = 85, den: int = 100, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept; links have Jaccard similarity >= num / den."""
    t = num / den
    rows, bands = plan_bands(t)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    made = materialize(signed(base, rows, bands))
    some = made.where("n > 0 and id is not null")
    classes = some.groupBy("s1", "s2").agg(F.min("id").alias("rep"))
    # members of a class hang on its representative; one id with several texts joins its classes
    hung = some.select("id", "s1", "s2").join(classes, ["s1", "s2"]).select(F.col("id").alias("u"), F.col("rep").alias("v"))
    reps = some.join(classes, ["s1", "s2"], "left_semi").groupBy("s1", "s2").agg(
        F.min(F.struct("id", "n", "bands")).alias("r")).select("r.id", "r.n", "r.bands", "s1", "s2")
    reps = materialize(reps)
    keyed = reps.select(F.explode("bands").alias("key"), "id")
    low = keyed.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").drop("high")
    coarse = keyed.join(low, "key").where("id <> low").select("id", "low").distinct()
    cluster = materialize(components(coarse))
    # blocks: size classes of ratio t inside a cluster, cut by hash into blocks
    c = cluster.join(reps.select("id", "n", "s1", "s2"), cluster["node"] == reps["id"]).select(
        "id", "s1", "s2", F.col("component").alias("cluster"), F.floor(F.log("n") / F.lit(-math.log(t))).alias("cls") if t < 1
        else F.col("n").alias("cls"))
    c = materialize(c)
    counts = c.groupBy("cluster", "cls").agg(F.count("*").alias("k"))
    total = counts.groupBy("cluster").agg(F.sum("k").alias("all"))
    nb = counts.join(total, "cluster").withColumn("blocks", F.ceil(F.col("k") / F.lit(BLOCK)).cast("int"))
    up = nb.select("cluster", (F.col("cls") - 1).alias("cls"), F.col("blocks").alias("above"))
    down = nb.select("cluster", (F.col("cls") + 1).alias("cls"), F.col("blocks").alias("below"))
    nb = nb.join(up, ["cluster", "cls"], "left").join(down, ["cluster", "cls"], "left").na.fill(0, ["above", "below"])
    m = c.join(nb, ["cluster", "cls"]).withColumn("block", F.pmod(F.xxhash64("id", "s1"), F.col("blocks")).cast("int"))
    span = lambda k: F.when(k > 0, F.sequence(F.lit(0), k - 1)).otherwise(F.array().cast("array<int>"))
    key = lambda lc, x, hc, y: F.xxhash64("cluster", lc, x, hc, y)
    own = F.transform(span(F.col("blocks")), lambda j: F.struct(
        key(F.col("cls"), F.least("block", j), F.col("cls"), F.greatest("block", j)).alias("task"),
        F.when(F.col("block") <= j, 0).otherwise(1).alias("side")))
    hi = F.transform(span(F.col("above")), lambda j: F.struct(
        key(F.col("cls"), F.col("block"), F.col("cls") + 1, j).alias("task"), F.lit(0).alias("side")))
    lo = F.transform(span(F.col("below")), lambda j: F.struct(
        key(F.col("cls") - 1, j, F.col("cls"), F.col("block")).alias("task"), F.lit(1).alias("side")))
    small = F.array(F.struct(F.xxhash64("cluster").alias("task"), F.lit(0).alias("side")))
    tasks = m.select("id", "s1", "s2", F.explode(F.when(F.col("all") <= BLOCK, small).otherwise(F.concat(own, hi, lo))).alias("t"))
    tasks = tasks.select("id", "t.task", "t.side")
    # texts of clustered documents only: their ids are broadcast while few, so the other texts are not shuffled
    ids = c.select("id").distinct()
    body = base.join(F.broadcast(ids) if c.count() <= IDS_BROADCAST else ids, "id", "left_semi")
    links = materialize(verified(body.join(tasks, "id").select("task", "side", "id", "text"), num, den))
    groups = components(links.unionAll(hung))
    out = made.select("id", "n").join(groups, made["id"] == groups["node"], "left")
    comp = F.coalesce(F.col("component"), F.col("id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), comp.alias("component_id"),
                      (F.col("id") == comp).alias("kept"))


def distinct_documents(docs: DataFrame, num: int = 80, den: int = 100, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row of each near-duplicate group: the smallest id, null ids last.

    Rows are grouped by a row number of their own, so null and repeated ids are documents of their own; rows without
    words stay."""
    cols = docs.columns
    rows = materialize(docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(cols)],
                                   F.monotonically_increasing_id().alias("_uid")), compression="zstd")
    named = {c: f"_k{i}" for i, c in enumerate(cols)}
    groups = near_duplicates(rows.select("_uid", F.col(named[text]).alias("text")), num, den, "_uid", "text")
    first = F.struct(F.col(named[id_col]).isNull().alias("n"), F.col(named[id_col]).alias("i"), F.col("_uid").alias("u"))
    best = (groups.join(rows.select("_uid", named[id_col]), groups["doc_id"] == F.col("_uid"))
            .groupBy("component_id").agg(F.min(first).alias("f")).select(F.col("f.u").alias("_uid")))
    return rows.join(best, "_uid", "left_semi").select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(cols)])


def op6(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, 85, 100)
