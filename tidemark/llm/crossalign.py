"""Alignment of two tokenizers over a corpus: token groups, linked pairs and how many documents hold each pair.

A text is encoded as space + text by tokenizer A (byte-level BPE) and as text by tokenizer B (pieces; it adds the space).
Byte offsets where tokens of both end cut the tokens into groups; every A token is linked with every B token of its group.

1. The first pass aligns every document and adds up, per task, in how many documents each pair of ids is linked; tasks
   write (pair, count) rows, at most ``HELD`` distinct pairs held at a time.
2. The distinct pairs are dealt into shards of about ``SHARD`` by hash. Each shard gets a *minimal perfect hash*: every pair
   is an edge of three vertices of a random hypergraph (1.23 vertices a pair), edges are peeled off vertices of degree one
   round by round, and in the reverse order each vertex gets a number mod 3 so that the sum over an edge names a vertex of
   its own; the rank of that vertex is the pair's place. The pairs are kept in this order, to verify look-ups.
3. Counts become dense vectors indexed by the hash: leaves of a tree sum the rows of a shard from some of the tasks, and
   vectors are summed ``FAN`` at a time until one is left for each shard.
4. The second pass aligns the documents again and looks their pairs up. While the vectors and pairs take at most
   ``BROADCAST`` bytes every worker gets them; beyond that the documents' (pair, links) rows are dealt to the shards and the
   sums come back by document. The highest count of each A id has one row per id of the vocabulary.

Defined results: null and empty texts, and texts whose tokens don't spell space + text (for one, a text holding U+2581), have
no tokens: zeros and an empty string. Strings of special tokens are ordinary text. Rows that repeat an id, and rows with a
null id, are documents of their own. Extra columns are ignored. An empty table gives no rows. Texts are read whole; a group
of very many tokens is counted by its distinct ids.

Ids come from the ``tokenizers`` and ``sentencepiece`` libraries. With ``ranks`` (A's vocabulary as ranks) and ``merges`` (B merges
by its pieces' scores, and every piece can be reached) plain texts (``PLAIN``: Latin letters, single spaces, no long runs) go
through ``tiktoken`` for both, which gives the same ids faster: B's merges never cross into a space, and its letters of two bytes
are merged first.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_key, map_arrow, materialize, texts

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

SHARD = 131_072
LEAF = 1_000_000  # rows that a leaf of the tree sums
FAN = 16
HELD = 2_000_000
BROADCAST = 96 << 20
SLICE = 4 << 20  # bytes of text aligned at once
WIDE = 4096  # links of a group from which it is counted by distinct ids
_INK = "[!-~\xa1-ɏ]"
#: Texts on which the quick encoders agree with the libraries, with runs short enough for them.
PLAIN = re.compile(f"\n{{0,399}}+(?:{_INK}{{1,399}}+(?: (?=\n|{_INK}|\\Z)|\n)(?:\n{{0,398}}+))*+{_INK}{{0,399}}+\\Z")
ODD = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


@dataclass(frozen=True)
class Pair:
    """Files of the two tokenizers; for the quick way ``ranks`` and ``pattern``, A's vocabulary as ranks and its split pattern, and
    ``merges``: B is a model that merges by scores."""

    a: str
    b: str
    ranks: str | None = None
    pattern: str | None = None
    merges: bool = False


class Aligner:
    """Encodes and aligns texts."""

    def __init__(self, files: Pair):
        import sentencepiece
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(files.a)
        self.lib.encode_special_tokens = True
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}
        vocab = self.lib.get_vocab()
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            self.a_bytes[i] = bytes(byte[c] for c in piece) if all(c in byte for c in piece) else piece.encode()
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=files.b)
        n = self.pieces.vocab_size()
        name = [self.pieces.id_to_piece(i) for i in range(n)]
        self.b_bytes = [bytes([int(s[3:5], 16)]) if self.pieces.is_byte(i) else s.replace("▁", " ").encode() for i, s in enumerate(name)]
        self.quick = self.quick_encoders(files, name) if files.ranks and files.merges else None
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        width = max(len(self.a_bytes), n)
        #: decimal ids followed by a separator: "," inside a side, "|" after A, ";" after B
        self.shown = np.array([f"{i}{c}".encode() for c in ",|;" for i in range(width)]).reshape(3, width)

    def quick_encoders(self, files: Pair, name: list[str]):
        """(encoder of A, encoder of B, B's ids by rank), or None if a piece of B can't be reached by merges."""
        import tiktoken

        with open(files.ranks, "rb") as f:
            ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, f)}
        a = tiktoken.Encoding("a", pat_str=files.pattern, mergeable_ranks=ranks, special_tokens={})
        p = self.pieces
        own = [i for i in range(len(name)) if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i)) and name[i] != "▁"]
        # a line break is never merged, so what follows it is encoded as inside a word
        alone = p.encode([name[i][1:].replace("▁", " ") if name[i][0] == "▁" else f"\n{name[i]}" for i in own], num_threads=1)
        if any(got[0 if name[i][0] == "▁" else 2:] != [i] for i, got in zip(own, alone)):
            return None
        letters = [i for i in own if len(name[i]) == 1 and len(self.b_bytes[i]) == 2]
        longer = sorted((i for i in own if len(name[i]) > 1), key=lambda i: -p.get_score(i))
        of_byte = {bytes([int(name[i][3:5], 16)]): i for i in range(len(name)) if p.is_byte(i)}
        of_byte |= {self.b_bytes[i]: i for i in range(len(name)) if len(name[i]) == 1 and len(self.b_bytes[i]) == 1}
        ids = [*letters, *longer, *of_byte.values()]
        keys = [*(self.b_bytes[i] for i in (*letters, *longer)), *of_byte]
        b = tiktoken.Encoding("b", pat_str=" ?[^ ]+| ", mergeable_ranks={k: r for r, k in enumerate(keys)}, special_tokens={})
        return a, b, np.array(ids, np.int64)

    def align(self, raws: list[bytes]) -> list[Aligned | None]:
        """One entry per text; None: no tokens."""
        return [self.one(r) if r else None for r in raws]

    def one(self, raw: bytes) -> Aligned | None:
        text = raw.decode("utf-8", "replace")
        if self.quick is not None and PLAIN.match(text):  # nothing is lost in these
            a, b, ids = self.quick
            return Aligned(self, np.array(a.encode_ordinary(f" {text}"), np.int64), ids[np.array(b.encode_ordinary(f" {text}"), np.int64)])
        want = b" " + raw
        ids_a = self.lib.encode(f" {text}", add_special_tokens=False).ids
        ids_b = self.pieces.encode(text)
        if any(b"".join(map(names.__getitem__, ids)) != want for names, ids in ((self.a_bytes, ids_a), (self.b_bytes, ids_b))):
            return None
        return Aligned(self, np.array(ids_a, np.int64), np.array(ids_b, np.int64))


class Aligned:
    """Tokens of one text with the group of each."""

    def __init__(self, by: Aligner, a: np.ndarray, b: np.ndarray):
        self.by, self.a, self.b = by, a, b
        ends_a, ends_b = np.cumsum(by.a_size[a]), np.cumsum(by.b_size[b])
        cuts = ends_a[ends_b[np.searchsorted(ends_b, ends_a)] == ends_a]
        self.ga, self.gb = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        self.groups = len(cuts)
        self.na, self.nb = np.bincount(self.ga, minlength=self.groups), np.bincount(self.gb, minlength=self.groups)

    @property
    def links(self) -> int:
        return int((self.na * self.nb).sum())

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct linked pairs (a << 32 | b) of the text, sorted, and how many links each has."""
        first_b = np.cumsum(self.nb) - self.nb
        wide = self.na * self.nb > WIDE
        i = np.flatnonzero(~wide[self.ga]) if wide.any() else np.arange(len(self.a))
        k = self.nb[self.ga[i]]
        at = np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k) + np.repeat(first_b[self.ga[i]], k)
        keys, times = np.unique((np.repeat(self.a[i], k) << 32) | self.b[at], return_counts=True)
        if not wide.any():
            return keys, times
        all_keys, all_times = [keys], [times]
        first_a = np.cumsum(self.na) - self.na
        for g in np.flatnonzero(wide):
            ua, ca = np.unique(self.a[first_a[g]:first_a[g] + self.na[g]], return_counts=True)
            ub, cb = np.unique(self.b[first_b[g]:first_b[g] + self.nb[g]], return_counts=True)
            all_keys.append(((ua << 32)[:, None] | ub).ravel())
            all_times.append((ca[:, None] * cb).ravel())
        return summed(np.concatenate(all_keys), np.concatenate(all_times))

    def digest(self) -> str:
        """sha256 of ``a1,a2|b1;a3|b2,b3``."""
        last_a, last_b = np.append(np.diff(self.ga) > 0, True), np.append(np.diff(self.gb) > 0, True)
        token = np.concatenate([self.by.shown[last_a.astype(int), self.a], self.by.shown[last_b * 2, self.b]])
        order = np.argsort(np.concatenate([self.ga * 2, self.gb * 2 + 1]), kind="stable")
        return hashlib.sha256(b"".join(token[order].tolist())[:-1]).hexdigest()


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sum of n of each."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[start], np.add.reduceat(n, start)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 over int64 or uint64 values."""
    x = x.view(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(ODD[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(ODD[1])
    return x ^ (x >> np.uint64(31))


def shard_hash(keys: np.ndarray) -> np.ndarray:
    return (mix(keys) >> np.uint64(33)).astype(np.int64)


def vertices(keys: np.ndarray, seed: np.ndarray | int, third: np.ndarray | int) -> np.ndarray:
    """Three vertices of each key (n x 3), one of each third of the vertices."""
    seed, third = np.asarray(seed, np.uint64), np.asarray(third, np.uint64)
    out = np.empty((len(keys), 3), np.int64)
    for i in range(3):
        h = mix(keys.view(np.uint64) ^ mix(np.atleast_1d(seed * np.uint64(3) + np.uint64(i + 1))))
        out[:, i] = (h % third).astype(np.int64) + i * third.astype(np.int64)
    return out


USED = 4


def perfect_hash(keys: np.ndarray) -> tuple[int, np.ndarray]:
    """(seed, g) of distinct keys: g holds a number mod 3 for each vertex, plus USED where a key has its own place."""
    third = -(-int(len(keys) * 1.23 + 3) // 3)
    for seed in range(1000):
        edge = vertices(keys, seed, third)
        rounds = peel(edge, 3 * third)
        if rounds is not None:
            break
    else:
        raise ValueError("no perfect hash: are the keys distinct?")
    g = np.zeros(3 * third, np.uint8)
    for e, own in reversed(rounds):
        v = edge[e]
        others = (g[v] & 3).sum(axis=1) - (g[v[np.arange(len(e)), own]] & 3)
        g[v[np.arange(len(e)), own]] = ((own - others) % 3).astype(np.uint8) | USED
    return seed, g


def peel(edge: np.ndarray, n: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (edges, which of their vertices is of degree one), or None if some edges can't be peeled."""
    degree = np.bincount(edge.ravel(), minlength=n)
    held = np.zeros(n, np.int64)  # xor of the edges at a vertex: the edge itself when there is one
    number = np.arange(len(edge))
    for i in range(3):
        np.bitwise_xor.at(held, edge[:, i], number)
    rounds, left = [], len(edge)
    at = np.flatnonzero(degree == 1)
    while len(at):
        e, first = np.unique(held[at], return_index=True)
        own = (edge[e] == at[first][:, None]).argmax(axis=1)
        rounds.append((e, own))
        left -= len(e)
        for i in range(3):
            np.subtract.at(degree, edge[e, i], 1)
            np.bitwise_xor.at(held, edge[e, i], e)
        near = np.unique(edge[e].ravel())
        at = near[degree[near] == 1]
    return rounds if not left else None


class Table:
    """Perfect hashes of shards, their keys in order and (later) their counts: look-ups over any of the shards."""

    def __init__(self, shards: int, rows: list[dict]):
        rows = sorted(rows, key=lambda r: r["shard"])
        self.shards = shards
        self.seed, self.third, self.vertex, self.base = (np.zeros(shards, np.int64) for _ in range(4))
        g = [np.frombuffer(r["g"], np.uint8) for r in rows]
        self.third[:] = 1
        v = k = 0
        for r, x in zip(rows, g):
            s = r["shard"]
            self.seed[s], self.third[s], self.vertex[s], self.base[s] = r["seed"], len(x) // 3, v, k
            v, k = v + len(x), k + len(r["keys"]) // 8
        none = np.zeros(0, np.int64)
        self.g = np.concatenate([*g, np.zeros(3, np.uint8)])
        # rank among the used vertices; shards lie one after another, and so do their keys
        self.rank = np.cumsum(self.g >= USED, dtype=np.int64) - 1
        self.keys = np.concatenate([none, *(np.frombuffer(r["keys"], np.int64) for r in rows)])
        self.counts = np.concatenate([none, *(np.frombuffer(r["counts"], np.int64) for r in rows if r.get("counts") is not None)])

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key; a key that isn't held is an error."""
        shard = shard_hash(keys) % self.shards
        v = vertices(keys, self.seed[shard], self.third[shard]) + self.vertex[shard][:, None]
        pick = (self.g[v] & 3).sum(axis=1) % 3
        place = self.rank[v[np.arange(len(v)), pick]]
        if len(keys) and (not len(self.keys) or (self.keys[place] != keys).any()):
            raise ValueError("a pair of the second pass was not met in the first")
        return place


_MADE: dict[Pair, Aligner] = {}


def aligner(files: Pair) -> Aligner:
    """The worker's aligner."""
    if files not in _MADE:
        _MADE[files] = Aligner(files)
    return _MADE[files]


def slices(b: pa.RecordBatch, text: int) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of runs of rows with about SLICE bytes of text."""
    held: list[bytes] = []
    size = at = 0
    for i, t in enumerate(texts(b.column(text))):
        held.append(t)
        size += len(t)
        if size >= SLICE:
            yield at, held
            held, size, at = [], 0, i + 1
    if held:
        yield at, held


def pair_counts(docs: DataFrame, files: Pair) -> DataFrame:
    """(key, h, n): in how many of a task's documents each pair is linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = aligner(files)
        keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        new: list[np.ndarray] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for lo in range(0, len(keys), 1 << 18):
                k = keys[lo:lo + (1 << 18)]
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(shard_hash(k)), pa.array(n[lo:lo + (1 << 18)])], names=["key", "h", "n"])

        for b in batches:
            for _, raws in slices(b, 0):
                for x in by.align(raws):
                    if x is not None:
                        new.append(x.pairs()[0])
                        size += len(new[-1])
                if size > HELD:
                    keys, n = summed(np.concatenate([keys, *new]), np.concatenate([n, np.ones(size, np.int64)]))
                    new, size = [], 0
                    if len(keys) > HELD:
                        yield from out()
                        keys, n = keys[:0], n[:0]
        keys, n = summed(np.concatenate([keys, *new]), np.concatenate([n, np.ones(size, np.int64)]))
        yield from out()

    return map_arrow(docs, run, "key long, h long, n long")


def hashed(counts: DataFrame) -> tuple[DataFrame, int, int]:
    """(shard, seed, g, keys) rows of the perfect hashes, the number of shards and of distinct pairs."""
    distinct = materialize(counts.groupBy("key").agg(F.any_value("h").alias("h")))
    total = distinct.count()
    shards = max(1, -(-total // SHARD))

    def build(group: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = group.column("key").to_numpy()
        seed, g = perfect_hash(keys)
        shard = group.column("shard")[0].as_py()
        order = np.empty_like(keys)
        only = Table(1, [{"shard": 0, "seed": seed, "g": g.tobytes(), "keys": b""}])
        v = vertices(keys, seed, len(g) // 3)
        order[only.rank[v[np.arange(len(v)), (g[v] & 3).sum(axis=1) % 3]]] = keys
        yield pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([seed]), pa.array([g.tobytes()], pa.binary()), pa.array([order.tobytes()], pa.binary())],
                                         names=["shard", "seed", "g", "keys"])

    keyed = distinct.select("key", (F.col("h") % F.lit(shards)).alias("shard"))
    return materialize(by_key(keyed, "shard", build, "shard long, seed long, g binary, keys binary")), shards, total


def with_tables(rows: DataFrame, tables: DataFrame, leaves: int, leaf, fn, schema: str) -> DataFrame:
    """``fn(table, rows)`` over the rows (with a column shard) of each shard and leaf, next to the shard's table row."""
    extra = [c for c in rows.columns if c != "shard"]
    blobs = [c for c in tables.columns if c != "shard"]
    kinds = dict(rows.dtypes) | dict(tables.dtypes)
    null = lambda c: F.lit(None).cast(kinds[c]).alias(c)
    group = F.col("shard") * F.lit(leaves)
    both = rows.select((group + leaf).alias("group"), "shard", *extra, *map(null, blobs)).unionAll(
        tables.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(leaves - 1)), lambda i: group + i)).alias("group"), "shard", *map(null, extra), *blobs))

    def run(group: pa.Table) -> Iterator[pa.RecordBatch]:
        is_table = group.column("g").is_valid()
        table = group.filter(is_table).select(["shard", *blobs]).to_pylist()[0]
        mine = group.filter(pa.compute.invert(is_table))
        if mine.num_rows:
            yield from fn(table, mine, group.column("group")[0].as_py())

    return by_key(both, "group", run, schema)


def counted(counts: DataFrame, tables: DataFrame, shards: int) -> DataFrame:
    """The tables with their dense count vectors, summed in a tree."""
    rows = counts.count()
    leaves = max(1, -(-rows // (shards * LEAF)))

    def leaf(table: dict, mine: pa.Table, group: int) -> Iterator[pa.RecordBatch]:
        own = Table(1, [dict(table, shard=0)])
        vec = np.zeros(len(own.keys), np.int64)
        np.add.at(vec, own.places(mine.column("key").to_numpy()), mine.column("n").to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array([group]), pa.array([vec.tobytes()], pa.binary())], names=["group", "counts"])

    def add(group: pa.Table) -> Iterator[pa.RecordBatch]:
        vec = sum(np.frombuffer(x.as_py(), np.int64) for x in group.column("counts"))
        yield pa.RecordBatch.from_arrays([group.column("group").chunk(0).slice(0, 1), pa.array([vec.tobytes()], pa.binary())], names=["group", "counts"])

    task = F.pmod(F.col("task"), F.lit(leaves)).cast("long")
    keyed = counts.select((F.col("h") % F.lit(shards)).alias("shard"), "key", "n", "task")
    vectors = with_tables(keyed, tables, leaves, task, leaf, "group long, counts binary")
    while leaves > 1:
        above = -(-leaves // FAN)
        up = F.floor(F.col("group") / leaves) * above + F.floor(F.pmod(F.col("group"), F.lit(leaves)) / FAN)
        vectors = by_key(vectors.select(up.cast("long").alias("group"), "counts"), "group", add, "group long, counts binary")
        leaves = above
    return tables.join(vectors.withColumnRenamed("group", "shard"), "shard")


def highest(tables: DataFrame) -> DataFrame:
    """(a, most): the highest count of any pair of each A id; one row per id of the vocabulary at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for keys, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                a, at = np.unique(np.frombuffer(keys, np.int64) >> 32, return_inverse=True)
                most = np.zeros(len(a), np.int64)
                np.maximum.at(most, at, np.frombuffer(counts, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(most)], names=["a", "most"])

    return map_arrow(tables.select("keys", "counts"), run, "a long, most long").groupBy("a").agg(F.max("most").alias("most"))


BASE = "uid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def described(batches: Iterator[pa.RecordBatch], files: Pair) -> Iterator[tuple[list, list[tuple[np.ndarray, np.ndarray]]]]:
    """Columns of BASE and the pairs of each document, for slices of (uid, doc_id, text) batches."""
    by = aligner(files)
    none = np.zeros(0, np.int64)
    for b in batches:
        for at, raws in slices(b, 2):
            got = by.align(raws)
            num = lambda f: pa.array([0 if x is None else f(x) for x in got], pa.int64())  # noqa: E731, B023
            yield [b.column(0).slice(at, len(raws)), b.column(1).slice(at, len(raws)), num(lambda x: len(x.a)), num(lambda x: len(x.b)),
                   num(lambda x: x.groups), num(lambda x: x.links), pa.array(["" if x is None else x.digest() for x in got])], \
                [(none, none) if x is None else x.pairs() for x in got]


def totals(table: Table, most: np.ndarray, keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums (from 0) of the best links and of the counts over links of pairs."""
    count = table.counts[table.places(keys)]
    best = np.where(count == most[keys >> 32], times, 0)
    return tuple(np.concatenate([[0], np.cumsum(x)]) for x in (best, times * count))


def cross_alignment(docs: DataFrame, files: Pair, id_col: str = "doc_id", text: str = "text", broadcast: int = BROADCAST) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair has the highest count of its A
    id), count_sum (of the counts over links), groups_sha256."""
    spark = docs.sparkSession
    counts = materialize(pair_counts(docs.select(F.col(text)), files).withColumn("task", F.spark_partition_id()))
    hashes, shards, total = hashed(counts)
    tables = materialize(counted(counts, hashes, shards))
    tops = highest(tables).collect()  # bounded by A's vocabulary
    most = np.zeros(1 + max([0, *(r.a for r in tops)]), np.int64)
    for r in tops:
        most[r.a] = r.most
    most = spark.sparkContext.broadcast(most)
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    names = [c.split()[0] for c in BASE.split(", ")]
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    if total * 18 <= broadcast:  # keys, counts and 1.23 bytes of hash a pair
        held = spark.sparkContext.broadcast([r.asDict() for r in tables.collect()])

        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = Table(shards, held.value)
            for cols, pairs in described(batches, files):
                best, sums = totals(table, most.value, np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs]))
                end = np.concatenate([[0], np.cumsum([len(p[0]) for p in pairs])])
                per = [pa.array(x[end[1:]] - x[end[:-1]]) for x in (best, sums)]
                yield pa.RecordBatch.from_arrays([*cols, *per], names=[*names, "n_best", "count_sum"])

        return map_arrow(rows, look_up, f"{BASE}, n_best long, count_sum long").select(*columns)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, pairs in described(batches, files):
            size = [len(p[0]) for p in pairs]
            off = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
            keys, times = (np.concatenate([p[i] for p in pairs]) for i in (0, 1))
            flat = pa.StructArray.from_arrays([pa.array(keys), pa.array(shard_hash(keys)), pa.array(times)], names=["key", "h", "times"])
            yield pa.RecordBatch.from_arrays([*cols, pa.ListArray.from_arrays(off, flat)], names=[*names, "asks"])

    asked = materialize(map_arrow(rows, ask, f"{BASE}, asks array<struct<key: long, h: long, times: long>>"))
    asks = asked.select("uid", F.explode("asks").alias("q")).select((F.col("q.h") % F.lit(shards)).alias("shard"), "uid", "q.key", "q.times")
    number = asked.agg(F.coalesce(F.sum(F.size("asks")), F.lit(0))).first()[0]
    leaves = max(1, -(-number // (shards * LEAF)))

    def tell(table: dict, mine: pa.Table, group: int) -> Iterator[pa.RecordBatch]:
        uid = mine.column("uid").to_numpy()
        order = np.argsort(uid, kind="stable")
        best, sums = totals(Table(1, [dict(table, shard=0)]), most.value, mine.column("key").to_numpy()[order], mine.column("times").to_numpy()[order])
        own, start = np.unique(uid[order], return_index=True)
        end = np.append(start[1:], len(uid))
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(best[end] - best[start]), pa.array(sums[end] - sums[start])], names=["uid", "n_best", "count_sum"])

    spread = F.pmod(F.xxhash64("uid"), F.lit(leaves)).cast("long")
    told = with_tables(asks, tables, leaves, spread, tell, "uid long, n_best long, count_sum long")
    told = told.groupBy("uid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return asked.drop("asks").join(told, "uid", "left").na.fill(0, ["n_best", "count_sum"]).select(*columns)


def op12(docs: DataFrame, files: Pair) -> DataFrame:
    return cross_alignment(docs, files)
