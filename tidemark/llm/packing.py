"""Packing of token sequences into windows by non-negative least squares over length combinations.

Every text is encoded once; its ids are cut into full windows and one remainder. Full windows are sequences by
themselves. The remainders' histogram over lengths is matched by *combinations* of at most three lengths that fill a
window exactly: the repeat counts x >= 0 minimise |A x - h|, are rounded down to what the histogram holds, and the
remainders a combination uses are dealt to its sequences by rank within their length. What is left (a few of each
length) is packed greedily: laid end to end in order of length and cut at window boundaries, so that only the last
sequence is short.

The histogram has at most ``window`` rows and is all that the driver sees. Ranks within a length come from counts per
(length, salt), so a length that holds a third of all rows is no hot partition.

Defined results: a null or empty text holds the end id alone; rows with a null or repeated ``doc_id`` are documents of
their own; extra columns are ignored; an empty table gives no rows; long texts are encoded whole and cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, materialize
from .ranks import Vocabulary, encoder

SALTS = 64
KEYS_BROADCAST = 500_000  # rows of five longs: at most 20 MB


def cut(docs: DataFrame, tokenizer: str | Vocabulary, end: int, window: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids): full windows and the remainder of each document; ids are binary,
    little-endian unsigned 32-bit."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    tail = np.array([end], "<u4").tobytes()
    step = 4 * window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            ids, start, total, body = [], [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = enc.ids(t) + tail
                for at in range(0, len(x), step):
                    ids.append(i)
                    start.append(at // 4)
                    total.append(len(x) // 4)
                    body.append(x[at:at + step])
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(start, pa.int64()), pa.array([len(x) // 4 for x in body], pa.int64()),
                pa.array(total, pa.int64()), pa.array(body, pa.binary())],
                names=["doc_id", "start", "length", "doc_tokens", "ids"])

    return map_arrow(rows, run, "doc_id long, start long, length long, doc_tokens long, ids binary")


def nnls(slots: np.ndarray, h: np.ndarray, steps: int = 300) -> np.ndarray:
    """x >= 0 minimising |A x - h| by accelerated projected gradient steps. Row j of ``slots`` lists the rows of A that
    combination j adds one to (``len(h)`` where it has fewer members); products with A go through these indices."""

    def ax(x: np.ndarray) -> np.ndarray:
        return np.bincount(slots.reshape(-1), np.repeat(x, slots.shape[1]), len(h) + 1)[:-1]

    def atr(r: np.ndarray) -> np.ndarray:
        return np.append(r, 0.0)[slots].sum(axis=1)

    v, norm = np.ones(len(slots)), 1.0
    for _ in range(20):  # largest eigenvalue of A'A by power iteration
        v = atr(ax(v))
        norm = np.linalg.norm(v)
        v /= max(norm, 1e-12)
    x = y = np.zeros(len(slots))
    rate, t = 1.0 / max(norm * 1.05, 1e-12), 1.0
    for _ in range(steps):
        new = np.maximum(0.0, y - rate * atr(ax(y) - h))
        t, old = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        y, x = new + (old - 1) / t * (new - x), new
    return x


def combinations(lengths: np.ndarray, window: int, thirds: int = 24) -> list[tuple[int, ...]]:
    """Shallow combinations of occurring lengths that fill the window exactly: all pairs, and for each length the
    triples with up to ``thirds`` evenly spaced second members."""
    have = set(lengths.tolist())
    out = [(a, window - a) for a in lengths.tolist() if a <= window - a and window - a in have]
    for a in lengths.tolist():
        seconds = [b for b in lengths.tolist() if a <= b <= window - a - b and window - a - b in have]
        for b in seconds[::max(1, len(seconds) // thirds)]:
            out.append((a, b, window - a - b))
    return out


def solve(hist: dict[int, int], window: int) -> list[tuple[tuple[int, ...], int]]:
    """(combination, repeats): rounded NNLS counts that the histogram can pay for.

    The system is solved on lengths in the histogram; counts are rounded down, then granted in descending order as far
    as the lengths last, and a last sweep grants what pairs and triples can still use.
    """
    lengths = np.array(sorted(n for n in hist if 0 < n < window))
    combos = combinations(lengths, window)
    if not combos:
        return []
    at = {n: i for i, n in enumerate(lengths.tolist())}
    h = np.array([hist[n] for n in lengths.tolist()], float)
    idx = np.full((len(combos), 3), len(lengths))
    for j, c in enumerate(combos):
        idx[j, :len(c)] = [at[n] for n in c]
    x = nnls(idx, h)
    left = h.astype(np.int64)
    out: dict[tuple[int, ...], int] = {}
    for ask in (np.floor(x + 0.5).astype(np.int64), None):  # the rounded counts, then whatever still fits
        for j in np.argsort(-x, kind="stable").tolist():
            c = combos[j]
            need: dict[int, int] = {}
            for n in c:
                need[at[n]] = need.get(at[n], 0) + 1
            can = min(left[i] // k for i, k in need.items())
            k = int(can if ask is None else min(can, ask[j]))
            if k > 0:
                out[c] = out.get(c, 0) + k
                for i, m in need.items():
                    left[i] -= m * k
    return list(out.items())


def _ranked(rows: DataFrame, by: str) -> DataFrame:
    """Adds ``rank``: a gapless number from 0 within ``by``; numbers inside salts plus the salts' offsets."""
    salted = rows.withColumn("_s", F.pmod(F.xxhash64("doc_id", "start", "uid"), F.lit(SALTS)).cast("int"))
    counts = salted.groupBy(by, "_s").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(by).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(by, "_s", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_o"))
    own = Window.partitionBy(by, "_s").orderBy("doc_id", "start", "uid")
    return salted.withColumn("_r", F.row_number().over(own) - 1).join(offs, [by, "_s"]).withColumn(
        "rank", F.col("_o") + F.col("_r")).drop("_s", "_o", "_r")


def plan(pieces: DataFrame, window: int) -> DataFrame:
    """Places (uid, doc_id, start, length) pieces: adds piece_start, piece_length, sequence_id, offset.

    Only left-over remainders are cut further. Sequence ids: combinations first, then full windows, then left-overs.
    """
    spark = pieces.sparkSession
    rest = pieces.where(F.col("length") < window)
    ranked = materialize(_ranked(rest.select("uid", "doc_id", "start", "length"), "length"))
    hist = {r["length"]: r["k"] for r in ranked.groupBy("length").agg(F.count("*").alias("k")).collect()}
    # per length: rank ranges [lo, hi) that go to a combination's slot; at most three rows a combination
    used: dict[int, int] = {}
    slots, seq = [], 0
    for c, k in solve(hist, window):
        at = 0
        for n in c:
            lo = used.get(n, 0)
            slots.append((n, lo, lo + k, seq - lo, at))
            used[n] = lo + k
            at += n
        seq += k
    schema = "length long, lo long, hi long, shift long, offset long"
    slot = spark.createDataFrame(slots, schema)
    # a remainder's slot is the last one of its length that starts at or before its rank: a range lookup by array
    table = slot.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "shift", "offset"))).alias("slots"))
    placed = ranked.join(F.broadcast(table), "length", "left")  # at most ``window`` rows
    hit = F.get(F.filter("slots", lambda s: (s["lo"] <= F.col("rank")) & (F.col("rank") < s["hi"])), F.lit(0))
    placed = materialize(placed.withColumn("hit", hit).select("uid", "doc_id", "start", "length", "rank", "hit.shift", "hit.offset"))
    combo = placed.where("shift is not null").select(
        "uid", "length", F.col("start").alias("piece_start"), F.col("length").alias("piece_length"),
        (F.col("rank") + F.col("shift")).alias("sequence_id"), "offset")
    # full windows: numbered inside the partitions that wrote them plus those partitions' offsets
    whole = pieces.where(F.col("length") == window).withColumn("p", F.shiftright("uid", 33))
    offs = whole.groupBy("p").agg(F.count("*").alias("k"))
    w = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    offs = offs.select("p", F.coalesce(F.sum("k").over(w), F.lit(0)).alias("o"))
    n_full = whole.count()
    full = whole.withColumn("r", F.row_number().over(Window.partitionBy("p").orderBy("uid")) - 1).join(offs, "p").select(
        "uid", "length", F.col("start").alias("piece_start"), F.col("length").alias("piece_length"),
        (F.col("o") + F.col("r") + seq).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    # left-overs: (length, rank) order gives a gapless token position from the histogram alone
    first, pos = [], 0
    for n in sorted(hist):
        k = hist[n] - used.get(n, 0)
        if k:
            first.append((n, used.get(n, 0), pos))
            pos += n * k
    base = seq + n_full
    loose = placed.where("shift is null").join(
        F.broadcast(spark.createDataFrame(first, "length long, lo long, pos long")), "length")
    at = F.col("pos") + (F.col("rank") - F.col("lo")) * F.col("length")
    loose = loose.withColumn("at", at).withColumn("room", F.lit(window) - F.pmod(F.col("at"), F.lit(window)))
    halves = F.array(
        F.struct(F.lit(0).cast("long").alias("o"), F.least("length", "room").alias("n")),
        F.struct(F.col("room").alias("o"), (F.col("length") - F.col("room")).alias("n")))
    loose = loose.withColumn("h", F.explode(F.filter(halves, lambda h: h["n"] > 0)))
    here = F.col("at") + F.col("h.o")
    loose = loose.select("uid", "length", (F.col("start") + F.col("h.o")).alias("piece_start"), F.col("h.n").alias("piece_length"),
                         (F.floor(here / F.lit(window)) + base).cast("long").alias("sequence_id"),
                         F.pmod(here, F.lit(window)).cast("long").alias("offset"))
    return combo.unionAll(full).unionAll(loose)


def placed(docs: DataFrame, tokenizer: str | Vocabulary, end: int = 1, window: int = 2048, id_col: str = "doc_id",
           text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(pieces with ids, plan), both written once and keyed by ``uid``."""
    pieces = materialize(cut(docs, tokenizer, end, window, id_col, text)
                         .withColumn("uid", F.monotonically_increasing_id()), compression="zstd")
    return pieces, materialize(plan(pieces.select("uid", "doc_id", "start", "length"), window))


def _joined(pieces: DataFrame, at: DataFrame) -> DataFrame:
    lo = (F.col("piece_start") - F.col("start")) * 4 + 1
    return pieces.join(at, "uid").select(
        "doc_id", F.col("piece_start").alias("start"), F.col("piece_length").alias("length"),
        F.substring("ids", lo.cast("int"), (F.col("piece_length") * 4).cast("int")).alias("ids"),
        "doc_tokens", "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer: str | Vocabulary, end: int = 1, window: int = 2048, id_col: str = "doc_id",
         text: str = "text") -> DataFrame:
    """Placed pieces with their ids: doc_id, start, length, ids, doc_tokens, sequence_id, offset."""
    pieces, at = placed(docs, tokenizer, end, window, id_col, text)
    return _joined(pieces.drop("length"), at.drop("length"))


def digest(pieces: DataFrame, at: DataFrame) -> DataFrame:
    """The packed pieces with the crc32 of their stored ids in place of the ids.

    Pieces that stay whole take their checksum where they are scanned, so their ids are not shuffled; only the ids of
    left-overs that were cut again are joined, by a broadcast of their keys while those are few.
    """
    whole = at.where("piece_length = length").drop("length")
    parts = at.where("piece_length < length").drop("length")
    sums = pieces.select("uid", "doc_id", "doc_tokens", F.crc32("ids").alias("ids_crc32"))
    kept = sums.join(whole, "uid").select("doc_id", F.col("piece_start").alias("start"), F.col("piece_length").alias("length"),
                                          "ids_crc32", "doc_tokens", "sequence_id", "offset")
    few = parts.count() <= KEYS_BROADCAST
    recut = _joined(pieces.drop("length"), F.broadcast(parts) if few else parts)
    return kept.unionAll(recut.withColumn("ids_crc32", F.crc32("ids")).select(kept.columns))


def op8(docs: DataFrame, tokenizer: str | Vocabulary) -> DataFrame:
    return digest(*placed(docs, tokenizer))
