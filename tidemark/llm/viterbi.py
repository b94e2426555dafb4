"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives one Viterbi pass.

The automaton reports, for each end position, every piece that ends there (its output links); each report relaxes the best
score of that position from the best score of the piece's start, so one pass over the text finds the segmentation with
the highest sum of piece scores. A character that no piece covers by itself may be taken as unknown at a penalty and is
written as its UTF-8 bytes.

White space is escaped to the word mark and a mark is put before the text. No piece holds a mark after another
character, and none holds a line feed, so the text falls apart at marks and line feeds without changing the best
path; parts are looked up in a bounded cache and the pass runs once per distinct part. Decoding joins the pieces, reads
runs of byte pieces as UTF-8, turns marks into spaces and drops the first one.

Defined results: null and empty texts have no ids and decode to the empty text; ids are passed through, null or
repeated; extra columns are ignored; an empty table gives no rows; a text that holds the mark character itself decodes
to spaces in its place (it does not round-trip). Long texts are encoded whole.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

MARK = "▁"
KEPT = 300_000  # distinct parts, and as many words, that a worker remembers
PARTS = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


class Model:
    """Pieces, scores and the automaton of a SentencePiece model file."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_ids = {int(self.pieces[i][3:-1], 16): i for i in range(n) if sp.is_byte(i)}
        self.bytes = {i: b for b, i in self.byte_ids.items()}
        self.control = {i for i in range(n) if sp.is_control(i)}
        self.unk = sp.unk_id()
        self.machine = ahocorasick.Automaton()
        low = 0.0
        self.chars: set[str] = set()
        for i, p in enumerate(self.pieces):
            if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                continue
            if MARK in p.lstrip(MARK) or "\n" in p:
                raise ValueError(f"piece {p!r} crosses a part boundary")
            s = sp.get_score(i)
            low = min(low, s)
            self.machine.add_word(p, (len(p), s, i))
            if len(p) == 1:
                self.chars.add(p)
        self.machine.make_automaton()
        self.penalty = low - 10.0
        self.parts = _Parts(self)
        self.decoded = [p.replace(MARK, " ") for p in self.pieces]

    def path(self, part: str) -> list[int]:
        """Ids of the best segmentation of one part."""
        n = len(part)
        best = [0.0] + [float("-inf")] * n
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        chars, at, penalty = self.chars, 0, self.penalty

        def unknowns(upto: int) -> None:
            nonlocal at
            while at < upto:  # positions whose own character is no piece may step over it
                if part[at] not in chars and best[at] + penalty > best[at + 1]:
                    best[at + 1], back[at + 1] = best[at] + penalty, (at, -1)
                at += 1

        for end, (size, score, i) in self.machine.iter(part):
            unknowns(end)
            start = end + 1 - size
            s = best[start] + score
            if s > best[end + 1]:
                best[end + 1], back[end + 1] = s, (start, i)
        unknowns(n)
        out: list[int] = []
        while n:
            start, i = back[n]
            if i >= 0:
                out.append(i)
            else:
                raw = part[start:n].encode()
                out += [self.byte_ids.get(b, self.unk) for b in reversed(raw)] if self.byte_ids else [self.unk]
            n = start
        return out[::-1]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if "  " in text or text[0] == " " or "\x01" in text or MARK in text:
            return b"".join(map(self.parts.__getitem__, PARTS.findall(MARK + text.replace(" ", MARK))))
        # single spaces: words carry their mark; a line feed goes with the word after it
        return b"".join(map(self.parts.of_word, text.replace("\n", " \x01").split(" ")))

    def decode(self, ids: tuple[int, ...]) -> str:
        """Text of the ids."""
        names, raw = self.decoded, self.bytes
        if raw.keys().isdisjoint(ids) and self.control.isdisjoint(ids):
            out = "".join([names[i] for i in ids])
        else:
            parts, run = [], bytearray()
            for i in ids:
                b = raw.get(i)
                if b is not None:
                    run.append(b)
                    continue
                if run:
                    parts.append(run.decode("utf-8", "replace"))
                    run.clear()
                if i not in self.control:
                    parts.append(names[i])
            parts.append(run.decode("utf-8", "replace"))
            out = "".join(parts)
        return out[1:] if out[:1] == " " else out


class _Parts(dict):
    """Ids of a part as bytes."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.words = _Words(self)
        self.of_word = self.words.__getitem__

    def __missing__(self, part: str) -> bytes:
        if len(self) >= KEPT:
            self.clear()
        ids = self.model.path(part)
        out = self[part] = struct.pack(f"<{len(ids)}I", *ids)
        return out


class _Words(dict):
    """Ids of a blank-separated word: its mark and itself, or (after \\x01) a line feed and what follows it."""

    def __init__(self, parts: _Parts):
        super().__init__()
        self.parts = parts

    def __missing__(self, word: str) -> bytes:
        if len(self) >= KEPT:
            self.clear()
        path = self.parts.model.path
        if word[:1] == "\x01":
            ids = path("\n")
            rest = word[1:]
            out = struct.pack(f"<{len(ids)}I", *ids) + (self[rest] if rest[:1] == "\x01" else b"" if not rest else self.parts[rest])
        else:
            ids = path(MARK + word)
            out = struct.pack(f"<{len(ids)}I", *ids)
        self[word] = out
        return out


_MADE: dict[str, Model] = {}


def model(path: str) -> Model:
    if path not in _MADE:
        _MADE[path] = Model(path)
    return _MADE[path]


def encode(docs: DataFrame, path: str, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """``keep`` (default ``doc_id``) and ``ids`` (binary, little-endian unsigned 32-bit)."""
    keep = ["doc_id"] if keep is None else keep
    rows = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text), F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in batches:
            ids = [m.encode(t) for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], pa.array(ids, pa.binary())], names=[*keep, "ids"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return map_arrow(rows, run, f"{kinds}, ids binary")


def decode(rows: DataFrame, path: str, keep: list[str] | None = None, ids: str = "ids") -> DataFrame:
    """``keep`` and ``decoded``: the text of each row's ids (null ids: null)."""
    keep = ["doc_id"] if keep is None else keep
    rows = rows.select(*[F.col(c) for c in keep], F.col(ids).alias("_ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in batches:
            got = [None if x is None else m.decode(struct.unpack(f"<{len(x) // 4}I", x)) for x in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], pa.array(got, pa.string())], names=[*keep, "decoded"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return map_arrow(rows, run, f"{kinds}, decoded string")


def round_trip(docs: DataFrame, path: str, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """``keep``, n_ids, ids_crc32 and whether the ids decode to the text (null counts as empty).

    Encoding and decoding share one pass and one worker, so neither texts nor ids leave it."""
    keep = ["doc_id"] if keep is None else keep
    rows = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text), F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in batches:
            n, crc, same = [], [], []
            for x in b.column(len(keep)):
                t = x.as_py()
                ids = m.encode(t)
                n.append(len(ids) // 4)
                crc.append(zlib.crc32(ids))
                same.append(m.decode(struct.unpack(f"<{len(ids) // 4}I", ids)) == t)
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(keep))], pa.array(n, pa.int64()), pa.array(crc, pa.int64()),
                                              pa.array(same, pa.bool_())], names=[*keep, "n_ids", "ids_crc32", "round_trip"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return map_arrow(rows, run, f"{kinds}, n_ids long, ids_crc32 long, round_trip boolean")


def op7(docs: DataFrame, path: str) -> DataFrame:
    return round_trip(docs, path)
