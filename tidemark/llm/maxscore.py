"""Exact top-k search over integer vectors by MaxScore.

Each component x becomes floor(64 x). The dimensions are the terms of a query: a posting list holds every vector's
component in that dimension (the lists are dense, so a list is a column of its shard) and the term's bound is the
largest product of the query's component with any of the shard's. Terms are ordered by bound; the smallest ones whose
bounds add up to less than the k-th best score so far are *non-essential*. The essential lists are traversed in full;
the non-essential ones are probed, largest bound first, only for vectors that can still reach the k-th score. A first
threshold comes from exact scores of ``SEED`` vectors of the shard. Shards give their best k per query, which are merged.

Vectors are dealt into shards of about ``SHARD`` and queries into blocks of about ``QUERIES`` by hash; a task scores one
block against one shard, so memory is bounded and nothing is broadcast. Scores are exact: sums stay under 2^53, or else
the shard is scored in Python integers and clipped to a long.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do null ids; an empty
vector scores 0 with everything; a shorter vector has no posting in the dimensions it lacks (0); a row repeating an
id is a candidate of its own for other queries, equal repeated queries are one query, and no row with the query's id is
its candidate; ties go to the smaller id; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, materialize, partitions

SHARD, QUERIES, SEED = 8192, 512, 512


def quantized(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, v array<double>) of the rows that take part; v holds whole numbers."""
    x = F.col(vector)
    ok = F.col(id_col).isNotNull() & x.isNotNull() & F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) != F.lit(float("inf"))))
    y = F.transform(x, lambda e: F.floor(F.lit(64.0) * e.cast("double")).cast("double"))
    return vectors.where(F.coalesce(ok, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), y.alias("v"))


def matrix(rows: list[np.ndarray]) -> np.ndarray:
    """Rows padded with zeros to the longest."""
    out = np.zeros((len(rows), max([1, *map(len, rows)])))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best: higher score, then smaller id."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= cut)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def maxscore(q: np.ndarray, own: int, ids: np.ndarray, columns: np.ndarray, high: np.ndarray, low: np.ndarray,
             seed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best of a shard for one query. ``columns`` is (dimensions, vectors); ``high`` and ``low`` are
    the extremes of each column; ``seed`` holds exact scores of the first vectors."""
    other = ids != own
    floor = seed[other[:len(seed)]]
    theta = np.partition(floor, len(floor) - k)[len(floor) - k] if len(floor) >= k else -np.inf
    bound = np.where(q > 0, q * high, q * low)
    order = np.argsort(-bound, kind="stable")
    rest = np.concatenate([np.cumsum(bound[order][::-1])[::-1], [0.0]])  # bound of all terms from a place on
    # essential: until what follows can't lift a vector from nothing over the threshold
    split = int(np.argmax(rest < theta)) if theta > 0 else len(order)
    essential = order[:split]
    acc = q[essential] @ columns[essential]
    at = np.flatnonzero(other & (acc + rest[split] >= theta))
    acc = acc[at]
    for j in range(split, len(order)):
        d = order[j]
        acc = acc + q[d] * columns[d, at]
        if len(at) > 4 * k:
            ok = acc + rest[j + 1] >= theta
            at, acc = at[ok], acc[ok]
    pick = best(ids[at], acc, k)
    return ids[at][pick], acc[pick]


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best vectors for each query (ids divisible by ``every``)."""
    rows = materialize(quantized(vectors, id_col, vector).withColumn("h", F.xxhash64("id", "v")))
    asks = rows.where(F.col("id") % every == 0).dropDuplicates(["id", "v"])
    n, nq = rows.count(), asks.count()
    shards, blocks = max(1, -(-n // SHARD)), max(1, -(-nq // QUERIES))
    spread = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    docs = rows.withColumn("shard", F.pmod("h", F.lit(shards)).cast("int")).withColumn("block", spread(blocks))
    qs = asks.withColumn("block", F.pmod(F.xxhash64("h"), F.lit(blocks)).cast("int")).withColumn("shard", spread(shards))
    task = (F.col("block") * F.lit(shards) + F.col("shard")).cast("int")
    both = docs.select(task.alias("task"), F.lit(False).alias("ask"), "id", "v").unionAll(
        qs.select(task.alias("task"), F.lit(True).alias("ask"), "id", "v"))

    def search(group: pa.Table) -> Iterator[pa.RecordBatch]:
        ask = group.column("ask").to_numpy().astype(bool)
        ids = group.column("id").to_numpy()
        flat = group.column("v").combine_chunks()
        off = flat.offsets.to_numpy()
        body = flat.values.to_numpy(zero_copy_only=False)
        vecs = [body[a:b] for a, b in zip(off[:-1], off[1:])]
        m = matrix(vecs)
        q, x, qi, xi = m[ask], m[~ask], ids[ask], ids[~ask]
        if not len(q) or not len(x):
            return
        whole = np.abs(q).max() * np.abs(x).max() * m.shape[1] < 2.0**53
        out = []
        if whole:
            columns = np.ascontiguousarray(x.T)
            high, low = columns.max(axis=1), columns.min(axis=1)
            seeds = q @ columns[:, :SEED]
            for i in range(len(q)):
                out.append((qi[i], *maxscore(q[i], qi[i], xi, columns, high, low, seeds[i], k)))
        else:
            big = [[int(e) for e in r] for r in x]
            for i in range(len(q)):
                a = [int(e) for e in q[i]]
                s = np.array([min(max(sum(u * v for u, v in zip(a, r)), -(2**63)), 2**63 - 1) for r in big], object)
                at = sorted((j for j in range(len(s)) if xi[j] != qi[i]), key=lambda j: (-s[j], xi[j]))[:k]
                out.append((qi[i], xi[at], s[at]))
        size = [len(r[1]) for r in out]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.array([r[0] for r in out], np.int64), size)),
            pa.array(np.repeat(np.flatnonzero(ask), size).astype(np.int64)),
            pa.array(np.concatenate([r[1] for r in out]).astype(np.int64)),
            pa.array([int(s) for r in out for s in r[2]], pa.int64())], names=["query_id", "q", "vec_id", "score"])

    # a query is told apart from another one of the same id by its vector's hash
    both = both.withColumn("h", F.xxhash64("id", "v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}
        last = None
        for b in batches:
            keys = b.column(0).to_numpy()
            for key in dict.fromkeys(keys.tolist()):
                if last is not None and key != last:
                    yield from named(pa.Table.from_batches(held.pop(last)))
                held.setdefault(key, []).append(b.filter(pa.array(keys == key)))
                last = key
        if last is not None:
            yield from named(pa.Table.from_batches(held.pop(last)))

    def named(group: pa.Table) -> Iterator[pa.RecordBatch]:
        h = group.column("h").to_numpy()
        for r in search(group):
            yield pa.RecordBatch.from_arrays([r.column(0), pa.array(h[r.column(1).to_numpy()]), r.column(2), r.column(3)],
                                             names=["query_id", "h", "vec_id", "score"])

    tasks = both.select("task", "ask", "id", "v", "h").repartition(max(partitions(rows), min(shards * blocks, 4096)), "task")
    found = map_arrow(tasks.sortWithinPartitions("task"), run, "query_id long, h long, vec_id long, score long")
    w = Window.partitionBy("query_id", "h").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2(vectors: DataFrame) -> DataFrame:
    return top_k(vectors)


SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as e from embeddings
           where embedding is not null and vec_id is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, d.vec_id, list_inner_product(q.e, d.e)::bigint as score
      from v q join v d on q.vec_id <> d.vec_id where q.vec_id % 20 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 20
"""
