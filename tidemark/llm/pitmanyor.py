"""Language-model scores by a hierarchical Pitman-Yor model: a restaurant for each previous word, with a shared root.

Tokens of a text are its words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, then one end token (the empty word).
A token's context is the whole word before it (the end token at a text's start). Each context u has a restaurant that
seats its tokens by word; every table is a customer of the root, whose base measure is diffuse, so the root has one table
a type and its new table is the one unknown type:

    p(w | u) = (c_uw - d1 t_uw) / (theta + c_u) + (theta + d1 T_u) / (theta + c_u) * p(w)
    p(w) = (t_w - d0) / (theta + T),   p(unknown) = (theta + d0 V) / (theta + T),   t_w = sum of t_uw over u

Seatings are sampled by a Gibbs chain: in a sweep each customer of every dish gets up and sits down again, given the
dish's other customers as they sit and the other dishes' tables of the last sweep. p is averaged over ``SAMPLES`` sweeps
after one of burn-in; discounts come from the counts of counts. Draws depend on word, context and sweep alone, so
a recomputed task repeats them. The sizes of the tables are written once a sweep, and the next sweep goes on from them:
customers of a dish are exchangeable, so who sits where need not be kept.

Work: texts are cut into chunks of about ``CHUNK`` bytes and read once: a chunk keeps its tokens as numbers in order of
arrival, and the 64-bit hashes of its words. The chunks' words are numbered once: a hashed range of words ranks the hashes. Each chunk then sends its distinct (context, word) pairs with training counts to groups, by a
hash of the word and ``SALT`` bits of the context, so that neither a common word nor a common context meets in one task.
Lists of numbers are sorted and sent as differences in compressed byte planes (:func:`squeeze`): two to four bytes a pair
instead of two hashes. Totals of contexts (T_u, c_u) and words (t_w, c_w) are exchanged between groups and ranges; all keys
go to the ranges only first and last, in between those of dishes with two customers or more. The probabilities go back to
the chunk in the order of its pairs; the chunk, stored bucketed so that its tokens are not shuffled, scores its documents.
There is a group and a range for every ``SHARE`` bytes of text. Only a few totals go to the driver; nothing that grows is
broadcast or collected.

Defined results: a null or empty text is the end token alone; a null id counts as the text '' for the split; every
row is scored, repeated rows too; extra columns are ignored; an empty table gives no rows; without training rows every
word is unknown. Long texts are scored whole.
"""

from __future__ import annotations

import random
import struct
import uuid
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from tidemark.session import work_dir

from .common import by_key, map_arrow, materialize, partitions

CHUNK, SHARE, SAMPLES, THETA = 24 << 20, 12 << 20, 2, 1.0
PIECE = 1 << 17
SWEEPS = 1 + SAMPLES
SALT, FEW = 15, 128  # mask of the context's bits in a pair's group; so many dishes or more take a step together
GOLD = 0x9E3779B97F4A7C15


class Words(dict):
    """Numbers for words in order of arrival, from 0 for the end token."""

    def __init__(self):
        super().__init__()
        self[b""]

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self)
        return i

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self), np.uint64, len(self))


def split(docs: list[bytes] | pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts, words a text)."""
    raw = docs if isinstance(docs, pa.Array) else pa.array(docs, pa.large_binary())
    parts = pc.ascii_split_whitespace(pc.ascii_lower(raw.cast(pa.large_string(), safe=False)))  # other bytes than UTF-8 stay
    words = parts.flatten()
    some = pc.binary_length(words).to_numpy() > 0  # white space at a text's ends leaves empty parts
    n = np.diff(np.append(0, np.cumsum(some))[parts.offsets.to_numpy()])
    return words if some.all() else words.filter(pa.array(some)), n


def listed(words: pa.Array) -> list[bytes]:
    """The values of a large string array without nulls, several times as fast as ``to_pylist``."""
    lo = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1].tolist()
    body = words.buffers()[2].to_pybytes() if len(words) and words.buffers()[2] else b""
    return [body[a:b] for a, b in zip(lo, lo[1:])]


def coded(words: Words, docs: list[bytes] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(keys, starts): word number << 32 | number of the word before, of every token, and each text's first token."""
    got, n = split(docs)
    got = got.dictionary_encode()
    number = np.fromiter(map(words.__getitem__, listed(got.dictionary)), np.int64, len(got.dictionary))
    ends = np.cumsum(n + 1)
    ix = np.full(int(ends[-1]) if len(ends) else 0, -1, np.int64)
    ix[ends - 1] = words[b""]
    ix[ix < 0] = number[got.indices.to_numpy()]
    # the token before a text's first is the end token of the text before
    return ix << 32 | np.concatenate([[0], ix[:-1]])[:len(ix)], (ends - n - 1).astype(np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def squeeze(x: np.ndarray, ordered: bool = False) -> bytes:
    """Integers as compressed byte planes, ``ordered`` ones as differences; :func:`spread` gives them back."""
    x = np.ascontiguousarray(x, np.int64)
    if ordered:
        x = np.diff(x, prepend=0)
    z = (x << 1) ^ (x >> 63)  # the sign goes last
    width = max(1, (int(z.view(np.uint64).max()).bit_length() + 7) // 8) if len(z) else 1
    planes = np.ascontiguousarray(z.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return struct.pack("<BQ", width, len(x)) + pa.Codec("zstd", compression_level=1).compress(planes.tobytes(), asbytes=True)


def spread(b: bytes, ordered: bool = False) -> np.ndarray:
    width, n = struct.unpack_from("<BQ", b)
    if not n:
        return np.empty(0, np.int64)
    z = np.zeros((n, 8), np.uint8)
    z[:, :width] = np.frombuffer(pa.Codec("zstd").decompress(b[9:], width * n, asbytes=True), np.uint8).reshape(width, n).T
    z = z.reshape(-1).view(np.uint64)
    x = (z >> np.uint64(1)).view(np.int64) ^ -(z & np.uint64(1)).view(np.int64)
    return np.cumsum(x) if ordered else x


def joined(blobs: pa.ChunkedArray, ordered: bool = False) -> np.ndarray:
    return np.concatenate([np.empty(0, np.int64), *(spread(b, ordered) for b in blobs.to_pylist())])


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``np.unique`` of numbers from 0 with their positions in it; one sort of numbers and places together where both fit."""
    bits = len(x).bit_length()
    if not len(x) or int(x.max()).bit_length() + bits > 63:
        return np.unique(x, return_inverse=True)
    both = x << bits
    del x
    both |= np.arange(len(both))
    both.sort()
    at = both & (1 << bits) - 1
    both >>= bits
    new = np.concatenate([[True], both[1:] != both[:-1]])
    rank, both = np.cumsum(new), both[new]
    rank -= 1
    back = np.empty(len(at), np.int64)
    back[at] = rank
    return both, back


def by_small(x: np.ndarray, n: int) -> np.ndarray:
    """Stable order of numbers below ``n``; 16 bits are sorted by radix."""
    return np.argsort(x.astype(np.uint16) if n <= 1 << 16 else x, kind="stable")


def ranged(hashes: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the sorted hashes by range and hash, and the ranges."""
    r = (hashes % np.uint64(nodes)).astype(np.int64)
    return by_small(r, nodes), r


def numbers_of(hashes: np.ndarray, replies: pa.Table, nodes: int) -> np.ndarray:
    """Corpus-wide numbers of a chunk's words: rank in the word's range * ``nodes`` + range."""
    h, back = np.unique(hashes, return_inverse=True)
    order, r = ranged(h, nodes)
    out = np.empty(len(h), np.int64)
    out[order] = joined(replies.sort_by("r").column("ranks"), True)
    return (out * nodes + r)[back]


def dealt(number: np.ndarray, got: np.ndarray, groups: int) -> tuple[np.ndarray, ...]:
    """(order by group, word numbers, context numbers, groups) of distinct pairs of positions among the sorted numbers."""
    w, u = number[got >> 32], number[got & 0xFFFFFFFF]
    q = (mixed(w.view(np.uint64) + np.uint64(GOLD) * (u & SALT).view(np.uint64)) % np.uint64(groups)).astype(np.int64)
    by = by_small(q, groups)
    return by, w[by], u[by], q[by]


def positions(number: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted numbers, keys with the words' positions among them)."""
    order = np.argsort(number)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return number[order], rank[keys >> 32] << 32 | rank[keys & 0xFFFFFFFF]


def counted(number: np.ndarray, keys: np.ndarray, train: np.ndarray, groups: int) -> tuple[np.ndarray, ...]:
    """(word number, context number, group, tokens of ``train``) of the distinct pairs, by group and numbers."""
    number, at = positions(number, keys)
    at = np.sort(at << 1 | train)  # a chunk has far fewer than 2**30 words
    first = np.flatnonzero(np.diff(at >> 1, prepend=-1))
    by, w, u, q = dealt(number, at[first] >> 1, groups)
    return w, u, q, np.add.reduceat(at & 1, first)[by]


def pairs_at(number: np.ndarray, keys: np.ndarray, groups: int) -> np.ndarray:
    """Each token's pair in the order of :func:`counted`."""
    number, keys = positions(number, keys)
    bits = len(number).bit_length()
    got, at = distinct(keys >> 32 << bits | keys & 0xFFFFFFFF)
    del keys
    by = dealt(number, got >> bits << 32 | got & (1 << bits) - 1, groups)[0]
    back = np.empty(len(by), np.int64)
    back[by] = np.arange(len(by))
    return back[at]


def staged(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of about ``PIECE`` tokens of a chunk: documents, the tokens of each, the tokens as numbers of the chunk's words, and
    a share of the words' hashes."""
    held = F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held_out"), F.col(text).alias("text"))

    def row(chunk: int, batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        docs, words = pa.Table.from_batches(batches), Words()
        texts = docs.column("text").cast(pa.large_binary()).combine_chunks()
        keys, starts = coded(words, texts.fill_null(b""))
        size = (pc.sum(pc.binary_length(texts)).as_py() or 0) + 100 * (len(texts) - texts.null_count)
        lo = np.flatnonzero(np.diff(starts // PIECE, prepend=-1))  # first text of each piece
        k, hashes, ends = len(lo), words.hashes(), np.append(starts, len(keys))
        cuts = np.append(lo, len(texts))
        listed = lambda c: pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), docs.column(c).combine_chunks())
        blobs = ([squeeze(np.diff(ends[a:b + 1])) for a, b in zip(cuts, cuts[1:])],
                 [squeeze(keys[a:b] >> 32) for a, b in zip(ends[cuts], ends[cuts[1:]])],
                 [h.tobytes() for h in np.array_split(hashes, k)])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(k, chunk)), pa.array(np.arange(k)), pa.array([size] + [0] * (k - 1)), listed("doc_id"),
             listed("held_out"), *(pa.array(b, pa.binary()) for b in blobs)],
            names=["chunk", "piece", "size", "doc_id", "held_out", "n", "tokens", "hashes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size = TaskContext.get().partitionId() << 24, 0
        kept: list[pa.RecordBatch] = []
        for b in batches:
            sizes, lo = pc.fill_null(pc.binary_length(b.column(2)), 0).to_numpy(zero_copy_only=False), 0
            for i, n in enumerate(sizes.tolist()):
                if size >= CHUNK:
                    yield row(chunk, [*kept, b.slice(lo, i - lo)])
                    release()
                    chunk, size, lo, kept = chunk + 1, 0, i, []
                size += n + 100
            kept.append(b.slice(lo))
        if size:
            yield row(chunk, kept)
            release()

    return map_arrow(rows, run, "chunk long, piece long, size long, doc_id array<long>, held_out array<boolean>, n binary, "
                                "tokens binary, hashes binary")


def release() -> None:
    """Gives the worker's unused Arrow memory back; workers live on from task to task."""
    pa.default_memory_pool().release_unused()


def hashes_of(chunk: pa.Table) -> np.ndarray:
    """Hashes of the words of a chunk's pieces in order."""
    return np.frombuffer(b"".join(chunk.column("hashes").to_pylist()), np.uint64)


def tokens_of(chunk: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(keys as :func:`coded` gives them, tokens a text) of a chunk's pieces in order."""
    tokens = joined(chunk.column("tokens"))
    return tokens << 32 | np.concatenate([[0], tokens[:-1]]), joined(chunk.column("n"))


def numbering(both: DataFrame, nodes: int) -> DataFrame:
    """chunk, r, ranks: for each chunk and range of words, the ranks of the chunk's words, by hash."""

    def hashed(chunk: pa.Table) -> pa.Table:
        h = np.unique(hashes_of(chunk))
        order, r = ranged(h, nodes)
        lo = np.searchsorted(r[order], np.arange(nodes + 1))
        some = np.flatnonzero(np.diff(lo))
        return pa.table({"r": some, "chunk": np.full(len(some), chunk.column("chunk")[0].as_py(), np.int64),
                         "keys": pa.array([h[order[lo[k]:lo[k + 1]]].tobytes() for k in some], pa.binary())})

    def ranked(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = [np.frombuffer(b, np.uint64) for b in rows.column("keys").to_pylist()]
        all_ = np.unique(np.concatenate(keys))
        yield pa.RecordBatch.from_arrays([
            rows.column("chunk").combine_chunks(), rows.column("r").combine_chunks(),
            pa.array([squeeze(np.searchsorted(all_, k), True) for k in keys], pa.binary())], names=["chunk", "r", "ranks"])

    sent = both.select("chunk", "hashes").groupBy("chunk").applyInArrow(hashed, "r long, chunk long, keys binary")
    return materialize(by_key(sent, "r", ranked, "chunk long, r long, ranks binary"), compression="zstd")


def lists(both: DataFrame, numbers: DataFrame, nodes: int, groups: int) -> DataFrame:
    """Per chunk and group the distinct pairs: words, pairs a word, contexts, training counts (0 where only held-out texts
    have the pair)."""

    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        release()
        docs = docs.sort_by("piece")
        keys, n = tokens_of(docs)
        train = np.repeat(~pc.list_flatten(docs.column("held_out")).to_numpy(), n)
        w, u, q, n = counted(numbers_of(hashes_of(docs), told, nodes), keys, train, groups)
        lo = np.searchsorted(q, np.arange(groups + 1))
        rows = []
        for k in np.flatnonzero(np.diff(lo)):
            s = slice(lo[k], lo[k + 1])
            first = np.flatnonzero(np.diff(w[s], prepend=-1))
            rows.append((k, squeeze(w[s][first], True), squeeze(np.diff(np.append(first, s.stop - s.start))),
                         squeeze(u[s], True), squeeze(n[s])))
        q, *blobs = zip(*rows)
        return pa.table({"q": np.array(q, np.int64), "chunk": np.full(len(q), docs.column("chunk")[0].as_py(), np.int64),
                         **{c: pa.array(b, pa.binary()) for c, b in zip(("w", "k", "u", "n"), blobs)}})

    kept = both.select("chunk", "piece", "held_out", "n", "tokens", "hashes")
    return kept.groupBy("chunk").cogroup(numbers.groupBy("chunk")).applyInArrow(
        run, "q long, chunk long, w binary, k binary, u binary, n binary")


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` written once into the shared folder, bucketed by ``key``; the catalog entry is dropped, the files stay."""
    spark = df.sparkSession
    name = f"llm_{uuid.uuid4().hex}"
    df.write.bucketBy(partitions(df), key).option("path", f"{work_dir(spark)}/{name}").option(
        "compression", "zstd").saveAsTable(name)
    out = spark.read.table(name)
    out.schema  # resolves the files and buckets before the entry goes
    spark.sql(f"drop table {name}")
    return out


def dishes(lists: DataFrame) -> DataFrame:
    """One row a group: its dishes (word, context, count) by word, how many have one and two customers, and the asking chunks
    with the dishes they ask for."""

    def summed(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.sort_by("chunk")
        w = np.concatenate([np.repeat(spread(a, True), spread(b)) for a, b in zip(*(rows.column(c).to_pylist() for c in "wk"))])
        u = [spread(b, True) for b in rows.column("u").to_pylist()]
        bounds, u = np.cumsum([0, *map(len, u)]), np.concatenate(u)
        bits = int(u.max()).bit_length()
        fits = int(w.max()).bit_length() + bits < 64
        order = np.argsort(w << bits | u, kind="stable") if fits else np.lexsort((u, w))  # merges the chunks' sorted lists
        ws, us = w[order], u[order]
        new = np.concatenate([[True], (ws[1:] != ws[:-1]) | (us[1:] != us[:-1])])
        at = np.empty(len(w), np.int64)
        at[order] = np.cumsum(new) - 1
        ws, us, c = ws[new], us[new], np.bincount(at, joined(rows.column("n")), int(new.sum())).astype(np.int64)
        first = np.flatnonzero(np.diff(ws, prepend=-1))
        out = {"w": squeeze(ws[first], True), "k": squeeze(np.diff(np.append(first, len(ws)))), "u": squeeze(us, True),
               "c": squeeze(c), "chunk": squeeze(rows.column("chunk").to_numpy(), True), "bounds": squeeze(bounds, True),
               "at": squeeze(at, True)}
        yield pa.RecordBatch.from_arrays(
            [rows.column("q").combine_chunks().slice(0, 1), pa.array([int((c == 1).sum())]), pa.array([int((c == 2).sum())]),
             *(pa.array([b], pa.binary()) for b in out.values())], names=["q", "ones", "twos", *out])

    return by_key(lists, "q", summed, "q long, ones long, twos long, w binary, k binary, u binary, c binary, chunk binary, "
                                      "bounds binary, at binary")


def uniforms(seed: np.ndarray, step: int) -> np.ndarray:
    """Uniform draws in [0, 1) per seed and step (splitmix64)."""
    x = seed + np.uint64(GOLD * (step + 1) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0**53


class Seats:
    """The customers of dishes at their tables, from one sitting down after the other to any number of sweeps.

    Each customer's table is kept, so a customer joins a table by joining another customer's (accepted in proportion to
    size - d over size). Dishes take their steps together; the ``FEW`` largest go one by one."""

    def __init__(self, c: np.ndarray, d: float, seed: np.ndarray):
        self.d, self.t, self.first = d, np.minimum(c, 1).astype(np.int64), True
        some = np.flatnonzero(c > 1)
        self.some = some[np.argsort(-c[some], kind="stable")]  # largest first: a step's dishes are a prefix
        self.c = c[self.some].astype(np.int64)
        self.seed = seed[self.some]
        self.off = np.cumsum(self.c) - self.c
        n = int(self.c.sum())
        self.table, self.size = np.zeros(n, np.int32), np.zeros(n, np.int32)
        self.free = (np.repeat(self.off + self.c - 1, self.c) - np.arange(n)).astype(np.int32)  # ids to open, the last first
        self.tab = np.zeros(len(self.c), np.int64)

    def load(self, table: np.ndarray) -> None:
        """Go on from the customers' tables of an earlier sweep."""
        n, own = len(table), np.repeat(np.arange(len(self.c)), self.c)
        self.table, self.first = table.astype(np.int32), False
        self.size = np.bincount(self.off[own] + table, minlength=n).astype(np.int32)
        none = np.flatnonzero(self.size == 0)  # ids to open, by dish
        self.tab = np.bincount(own[self.size > 0], minlength=len(self.c)).astype(np.int64)
        left = self.c - self.tab
        at = np.arange(len(none)) - np.repeat(np.cumsum(left) - left, left)
        self.free[self.off[own[none]] + at] = none - self.off[own[none]]
        self.t[self.some] = self.tab

    def sizes(self) -> np.ndarray:
        """Sizes of the tables, by dish."""
        return self.size[self.size > 0]

    def seated(self, tab: np.ndarray, sizes: np.ndarray) -> None:
        """Go on from ``tab`` tables a dish of these sizes."""
        self.load(np.repeat(np.arange(len(sizes)) - np.repeat(np.cumsum(tab) - tab, tab), sizes))

    def sweep(self, i: int, fresh: np.ndarray, more: np.ndarray) -> None:
        """Every customer gets up and sits down again; a new table weighs ``fresh`` + ``more`` per table opened since."""
        if len(self.c):
            f, g, start = fresh[self.some], more[self.some], np.maximum(self.tab, 1)
            for seated in ((False, True) if self.first else (True,)):
                base = (2 * i + seated) << 33
                lo = min(FEW, len(self.c))
                steps = int(self.c[lo]) if lo < len(self.c) else 0
                for k, hi in enumerate(np.searchsorted(-self.c, -np.arange(steps), "left").tolist()):
                    self._step(k, lo, hi, f, g, start, seated, base)
                for j in range(lo):
                    self._alone(j, float(f[j]), float(g[j]), int(start[j]), seated, base)
            self.first = False
        self.t[self.some] = self.tab

    def _step(self, i: int, lo: int, hi: int, f: np.ndarray, g: np.ndarray, start: np.ndarray, seated: bool, base: int) -> None:
        """Customer i of the dishes lo to hi."""
        off, tab, c = self.off[lo:hi], self.tab[lo:hi], self.c[lo:hi]
        if seated:
            k = self.table[off + i]
            self.size[off + k] -= 1
            gone = np.flatnonzero(self.size[off + k] == 0)
            tab[gone] -= 1
            self.free[off[gone] + c[gone] - tab[gone] - 1] = k[gone]
        n = c - 1 if seated else np.full(hi - lo, i)
        new = np.maximum(f[lo:hi] + g[lo:hi] * (tab - start[lo:hi]), 1e-300)
        old = n - self.d * tab
        seed, step = self.seed[lo:hi], base + 64 * i
        fresh = uniforms(seed, step) * (old + new) >= old
        k = np.empty(hi - lo, np.int64)
        todo = np.flatnonzero(~fresh)
        while len(todo):
            step += 2
            r = (uniforms(seed[todo], step) * n[todo]).astype(np.int64)
            if seated:
                r += r >= i
            pick = self.table[off[todo] + r]
            size = self.size[off[todo] + pick]
            k[todo] = pick
            todo = todo[uniforms(seed[todo], step + 1) * size >= size - self.d]
        at = np.flatnonzero(fresh)
        k[at] = self.free[off[at] + c[at] - tab[at] - 1]
        tab[at] += 1
        self.size[off + k] += 1
        self.table[off + i] = k

    def _alone(self, j: int, f: float, g: float, start: int, seated: bool, base: int) -> None:
        """All customers of dish j, one after the other."""
        a, c, d = int(self.off[j]), int(self.c[j]), self.d
        table, size, free = (x[a:a + c].tolist() for x in (self.table, self.size, self.free))
        tab, draw = int(self.tab[j]), random.Random(int(self.seed[j]) + base).random
        n = c - 1  # others when all are seated
        old, new = n - d * tab, max(f + g * (tab - start), 1e-300)
        for i in range(c):
            if seated:
                k = table[i]
                size[k] -= 1
                if not size[k]:
                    tab -= 1
                    free[c - tab - 1] = k
                    old, new = n - d * tab, max(f + g * (tab - start), 1e-300)
            else:
                n, old = i, i - d * tab
            if draw() * (old + new) >= old:
                k = free[c - tab - 1]
                tab += 1
                old, new = n - d * tab, max(f + g * (tab - start), 1e-300)
            else:
                while True:
                    r = int(draw() * n)
                    k = table[r + 1 if seated and r >= i else r]
                    s = size[k]
                    if draw() * s < s - d:
                        break
            size[k] += 1
            table[i] = k
        self.table[a:a + c], self.size[a:a + c], self.free[a:a + c], self.tab[j] = table, size, free, tab


def seat(c: np.ndarray, fresh: np.ndarray, d: float, seed: np.ndarray, sweep: int) -> np.ndarray:
    """Tables of c customers of one dish each after one sweep; ``fresh`` is the weight of a new table."""
    s = Seats(c, d, seed)
    s.sweep(sweep, fresh, np.zeros(len(c)))
    return s.t


def discount(n1: int, n2: int) -> float:
    return min(max(n1 / (n1 + 2 * n2) if n1 + n2 else 0.5, 0.05), 0.95)


class Group:
    """The dishes of one group and the keys of their words (odd) and contexts (even), all and of dishes of two or more."""

    def __init__(self, row: pa.Table, nodes: int):
        get = lambda c, ordered=False: spread(row.column(c)[0].as_py(), ordered)
        self.row, self.q, self.nodes = row, row.column("q")[0].as_py(), nodes
        w, u, self.c = np.repeat(get("w", True), get("k")), get("u", True), get("c")
        self.seed = mixed(w.view(np.uint64) + np.uint64(GOLD) * u.view(np.uint64))
        # range << shift | twice the rank in it, and 1 for a word
        w, wr = np.divmod(w, nodes)
        u, ur = np.divmod(u, nodes)
        self.shift = int(max(w.max(), u.max())).bit_length() + 1
        self.keys = np.concatenate([wr << self.shift | w << 1 | 1, ur << self.shift | u << 1])
        self.several = np.tile(self.c > 1, 2)

    @cached_property
    def all(self) -> tuple[np.ndarray, np.ndarray]:
        """(sorted keys of all dishes, positions of the dishes' words and contexts among them)."""
        return distinct(self.keys)

    @cached_property
    def some(self) -> tuple[np.ndarray, np.ndarray]:
        """The same of the dishes of two customers or more."""
        return distinct(self.keys[self.several])

    def asking(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(chunks, bounds, dishes): the dishes of the pairs that each chunk asks for."""
        return tuple(spread(self.row.column(c)[0].as_py(), True) for c in ("chunk", "bounds", "at"))

    def send(self, asked: tuple, values: list[np.ndarray], reply: np.ndarray | None = None) -> pa.Table:
        """Keys and sums of ``values`` over their dishes, a row a range; replies are wanted where ``reply``, or for all."""
        keys, at = asked
        sums = [np.bincount(at, np.tile(v, 2), len(keys)).astype(np.int64) for v in values]
        lo = np.searchsorted(keys, np.arange(self.nodes + 1) << self.shift)
        some = np.flatnonzero(np.diff(lo))
        cut = lambda x: [x[lo[k]:lo[k + 1]] for k in some]
        return pa.table({
            "r": some, "q": np.full(len(some), self.q, np.int64),
            "keys": pa.array([squeeze(x & (1 << self.shift) - 1, True) for x in cut(keys)], pa.binary()),
            "vals": pa.array([squeeze(np.concatenate(x)) for x in zip(*map(cut, sums))], pa.binary()),
            "reply": pa.array([b""] * len(some) if reply is None else [squeeze(x) for x in cut(reply)], pa.binary())})

    def told(self, asked: tuple, replies: pa.Table, step: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Totals of each dish's word and context (columns of k) in the replies of ``step``."""
        mine = replies.filter(pc.and_(pc.equal(replies.column("step"), step), pc.greater_equal(replies.column("r"), 0))).sort_by("r")
        vals = [spread(b).reshape(k, -1) for b in mine.column("vals").to_pylist()]
        vals = np.concatenate([np.empty((k, 0), np.int64), *vals], axis=1).T[asked[1]]
        return vals[:len(vals) // 2], vals[len(vals) // 2:]


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row of ``docs``."""
    both = bucketed(staged(docs, id_col, text), "chunk")
    size = both.agg(F.sum("size")).first()[0] or 0
    groups = nodes = max(partitions(docs), size // SHARE + 1)
    numbers = numbering(both, nodes)
    static = bucketed(dishes(lists(both, numbers, nodes, groups)), "q")

    def exchange(sent: DataFrame, step: int, k: int) -> tuple[DataFrame, np.ndarray]:
        """(totals of the keys that groups ask for; sums over words: totals, and how many have 1, 2, more)."""

        def totals(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            keys = [spread(b, True) for b in rows.column("keys").to_pylist()]
            vals = np.concatenate([spread(b).reshape(k, -1) for b in rows.column("vals").to_pylist()], axis=1)
            bounds = np.cumsum([0, *map(len, keys)])
            got, at = distinct(np.concatenate(keys))
            total = np.stack([np.bincount(at, v, len(got)).astype(np.int64) for v in vals])
            word = total[:, (got & 1) == 1]
            stat = np.stack([word.sum(axis=1), (word == 1).sum(axis=1), (word == 2).sum(axis=1), (word > 0).sum(axis=1)])
            out = []
            for lo, hi, mask in zip(bounds, bounds[1:], rows.column("reply").to_pylist()):
                mine = at[lo:hi][spread(mask) > 0] if mask else at[lo:hi]
                # what is asked for first is added to by later steps: tables beyond one a dish
                out.append(squeeze((total[1:] if step == 0 else total)[:, mine].reshape(-1)))
            n, names = rows.num_rows, ["step", "q", "r", "keys", "vals", "stat"]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, step)), rows.column("q").combine_chunks(), rows.column("r").combine_chunks(),
                pa.array([b""] * n), pa.array(out, pa.binary()), pa.nulls(n, pa.list_(pa.int64()))], names=names)
            yield pa.RecordBatch.from_arrays([
                pa.array([step]), pa.array([-1]), pa.array([rows.column("r")[0].as_py()]), pa.array([b""]), pa.array([b""]),
                pa.array([stat.reshape(-1).tolist()], pa.list_(pa.int64()))], names=names)

        out = materialize(by_key(sent, "r", totals, "step long, q long, r long, keys binary, vals binary, stat array<long>"),
                          compression="zstd")
        s = out.where("q = -1").agg(*[F.sum(F.col("stat")[i]) for i in range(4 * k)]).first()
        return out.where("q >= 0").drop("stat"), np.array([x or 0 for x in s], np.float64).reshape(4, k)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                g = Group(pa.Table.from_batches([b.slice(i, 1)]), nodes)
                reply = np.bincount(g.all[1], g.several, len(g.all[0])).astype(bool)
                yield from g.send(g.all, [g.c, np.minimum(g.c, 1)], reply).combine_chunks().to_batches()

    sent = "r long, q long, keys binary, vals binary, reply binary"
    replies, stat = exchange(map_arrow(static, first, sent), 0, 2)
    total, types, tables0 = int(stat[0, 0]), stat[3, 0], stat[0, 1]
    d1 = discount(*(x or 0 for x in static.agg(F.sum("ones"), F.sum("twos")).first()))
    d0 = discount(stat[1, 1], stat[2, 1])
    opened = [0.0]  # tables beyond one a dish after each sweep

    def state(told: pa.Table, step: int, column: str) -> np.ndarray:
        """Tables a dish (keys) or their sizes (vals) after a sweep; a group's state has range -1."""
        row = told.filter(pc.and_(pc.equal(told.column("step"), step), pc.equal(told.column("r"), -1)))
        return spread(row.column(column)[0].as_py())

    def swept(i: int):
        def run(row: pa.Table, told: pa.Table) -> pa.Table:
            """Sends the group's new tables, and its seatings for the next sweep."""
            g = Group(row, nodes)
            s, some = Seats(g.c, d1, g.seed), g.c > 1
            if i > 1:
                s.seated(state(told, i - 1, "keys"), state(told, i - 1, "vals"))
            word, ctx = (x[:, 0] for x in g.told(g.some, told, 0, 1))
            w, u = (x[:, 0] for x in g.told(g.some, told, i - 1, 1)) if i > 1 else (0.0, 0.0)
            fresh, more = np.zeros(len(g.c)), np.zeros(len(g.c))
            p = np.maximum((word + w - d0) / (THETA + tables0 + opened[i - 1]), 1e-12)
            fresh[some], more[some] = (THETA + d1 * (ctx + u)) * p, d1 * p
            before = s.t.copy()  # the first of the two samples, when this is the last sweep
            s.sweep(i, fresh, more)
            if i < SWEEPS:
                out = g.send(g.some, [(s.t - 1)[some]])
            else:
                out = g.send(g.all, [g.c, before, s.t])
            return pa.concat_tables([out, pa.table({"r": [-1], "q": [g.q], "keys": [squeeze(s.tab)], "vals": [squeeze(s.sizes())],
                                                    "reply": [b""]})])

        return run

    def job(fn, told: DataFrame, schema: str) -> DataFrame:
        return static.groupBy("q").cogroup(told.groupBy("q")).applyInArrow(fn, schema)

    start, states = replies, []
    for i in range(1, SWEEPS + 1):
        out = materialize(job(swept(i), replies, sent), compression="zstd")
        new, stat = exchange(out.where("r >= 0"), i, 1 if i < SWEEPS else 1 + SAMPLES)
        opened.append(stat[0, 0])
        states.append(out.where("r = -1").select(F.lit(i).cast("long").alias("step"), "q", "r", "keys", "vals"))
        replies = start.unionAll(new).unionAll(states[-1])
    told = new.unionAll(states[-2]).unionAll(states[-1])
    roots = [(stat[0, 1 + k], discount(stat[1, 1 + k], stat[2, 1 + k])) for k in range(SAMPLES)]

    def price(row: pa.Table, told: pa.Table) -> pa.Table:
        """Answers by chunk: the counts of its pairs' words and log10 of the pairs' averaged probabilities."""
        g = Group(row, nodes)
        word, ctx = g.told(g.all, told, SWEEPS, 1 + SAMPLES)
        scale, p = THETA + ctx[:, 0], np.zeros(len(g.c))
        several = Seats(g.c, d1, g.seed).some
        for k in range(SAMPLES):
            t, (tabs, d) = np.minimum(g.c, 1), roots[k]
            t[several] = state(told, SWEEPS - 1 + k, "keys")
            root = np.where(word[:, 1 + k] > 0, word[:, 1 + k] - d, THETA + d * types) / (THETA + tabs)
            p += (np.maximum(g.c - d1 * t, 0.0) + (THETA + d1 * ctx[:, 1 + k]) * root) / scale / SAMPLES
        chunks, bounds, at = g.asking()
        c, p = word[:, 0], np.log10(p).astype("<f4").view("<i4")
        cut = lambda x, ordered: pa.array(
            [squeeze(x[at[lo:hi]], ordered) for lo, hi in zip(bounds, bounds[1:])], pa.binary())
        return pa.table({"chunk": chunks, "q": np.full(len(chunks), g.q, np.int64), "c": cut(c, True), "p": cut(p, False)})

    # a chunk also needs its words' numbers again, in rows with q below 0
    answers = job(price, told, "chunk long, q long, c binary, p binary").unionAll(
        numbers.select("chunk", (-1 - F.col("r")).alias("q"), F.col("ranks").alias("c"), F.lit(None).cast("binary").alias("p")))

    def score(asks: pa.Table, told: pa.Table) -> pa.Table:
        own = told.filter(pc.less(told.column("q"), 0))
        number = pa.table({"r": pc.subtract(-1, own.column("q")), "ranks": own.column("c")})
        told = told.filter(pc.greater_equal(told.column("q"), 0)).sort_by("q")
        c, p = joined(told.column("c"), True), joined(told.column("p")).astype("<i4").view("<f4")
        # the texts' distinct pairs by group and numbers are the answers in order
        asks = asks.sort_by("piece")
        keys, n = tokens_of(asks)
        number = numbers_of(hashes_of(asks), number, nodes)
        del told, own
        release()
        at = pairs_at(number, keys, groups)
        del keys
        starts = np.cumsum(n) - n
        base = np.log10((c + 0.5) / (total + 0.5 * (types + 1)))
        return pa.table({
            "doc_id": pc.list_flatten(asks.column("doc_id")), "held_out": pc.list_flatten(asks.column("held_out")), "n_tokens": n,
            "n_known": np.add.reduceat((c > 0).astype(np.int64)[at], starts), "train_tokens": np.full(len(n), total, np.int64),
            "base_score": np.add.reduceat(base[at], starts), "score": np.add.reduceat(p.astype(np.float64)[at], starts)})

    return both.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op10(docs: DataFrame) -> DataFrame:
    return lm_scores(docs)
