"""Word-piece token counts by a linear longest-match automaton.

Greedy longest-match-first segmentation of a word needs no backtracking: the vocabulary's trie gets a failure link
f(v) for each node and the *number* of pieces that are popped on following it. Scanning a character follows its trie edge or
pops pieces along failure links, so a word of n characters takes O(n) steps and no piece is ever built.

The vocabulary comes from a SentencePiece model file: pieces that start with the word mark begin words, the others
continue them; control, byte and unknown pieces are left out. A word (maximal run of characters other than ASCII
white space) that greedy matching can't cover counts as one unknown piece. Counts of words are remembered per worker in
a bounded cache; the automaton runs once per distinct word.

Defined results: null, empty and blank texts have no words and no pieces; ids are passed through, null or repeated;
extra columns are ignored; an empty table gives no rows. Long texts are counted whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

MARK = "▁"
KEPT = 1_000_000  # distinct words that a worker remembers


class LinearMatch:
    """Longest-match automaton over ``starts`` (pieces that begin a word) and ``inner`` (pieces that continue one)."""

    def __init__(self, starts: list[str], inner: list[str]):
        # node 0: root of words; node 1: root of continuations
        self.edge: list[dict[str, int]] = [{}, {}]
        final = [False, False]
        order: list[tuple[int, int, str]] = []  # (parent, node, character)
        for root, words in ((0, starts), (1, inner)):
            for w in words:
                at = root
                for ch in w:
                    nxt = self.edge[at].get(ch)
                    if nxt is None:
                        nxt = len(self.edge)
                        self.edge.append({})
                        final.append(False)
                        self.edge[at][ch] = nxt
                    at = nxt
                if w:
                    final[at] = True
        queue = [0, 1]
        for at in queue:
            for ch, nxt in self.edge[at].items():
                order.append((at, nxt, ch))
                queue.append(nxt)
        self.fail: list[int] = [-1] * len(self.edge)
        self.pops: list[int] = [0] * len(self.edge)
        for up, v, ch in order:
            if final[v]:
                self.fail[v], self.pops[v] = 1, 1
                continue
            z, popped = self.fail[up], self.pops[up]
            while z != -1 and ch not in self.edge[z]:
                popped += self.pops[z]
                z = self.fail[z]
            if z != -1:
                self.fail[v], self.pops[v] = self.edge[z][ch], popped

    def count(self, word: str) -> int:
        """Pieces of a word, or -1 if greedy matching can't cover it."""
        edge, fail, pops = self.edge, self.fail, self.pops
        at, n = 0, 0
        for ch in word:
            nxt = edge[at].get(ch)
            while nxt is None:
                if fail[at] == -1:
                    return -1
                n += pops[at]
                at = fail[at]
                nxt = edge[at].get(ch)
            at = nxt
        while at > 1:
            if fail[at] == -1:
                return -1
            n += pops[at]
            at = fail[at]
        return n


def pieces_of(model: str) -> tuple[list[str], list[str]]:
    """(starts, inner) of a SentencePiece model file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    starts, inner = [], []
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i):
            continue
        p = sp.id_to_piece(i)
        if p.startswith(MARK):
            starts.append(p[len(MARK):])
        else:
            inner.append(p)
    return [p for p in starts if p], inner


class _Counts(dict):
    """Pieces of a word; an uncovered word is stored as -1."""

    def __init__(self, model: str):
        super().__init__()
        self.machine = LinearMatch(*pieces_of(model))

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT:
            self.clear()
        n = self[word] = self.machine.count(word.decode())
        return n


_MADE: dict[str, _Counts] = {}


def token_counts(docs: DataFrame, model: str, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """``keep`` (default ``doc_id``), n_words, n_pieces (an unknown word is one piece), n_unknown."""
    keep = ["doc_id"] if keep is None else keep
    rows = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model not in _MADE:
            _MADE[model] = _Counts(model)
        counts = _MADE[model].__getitem__
        for b in batches:
            words, total, unknown = [], [], []
            for t in b.column(len(keep)).to_pylist():
                w = t.split()
                c = np.fromiter(map(counts, w), np.int64, len(w))
                bad = int(np.count_nonzero(c < 0))
                words.append(len(w))
                unknown.append(bad)
                total.append(int(c.sum()) + 2 * bad)
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], *[pa.array(x, pa.int64()) for x in (words, total, unknown)]],
                                             names=[*keep, "n_words", "n_pieces", "n_unknown"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return map_arrow(rows, run, f"{kinds}, n_words long, n_pieces long, n_unknown long")


def op4(docs: DataFrame, model: str) -> DataFrame:
    return token_counts(docs, model)
