"""Token ids of whole texts by the ``tokenizers`` library, with each distinct word encoded once per worker.

Both vocabularies split a text before merging, and no merge crosses white space. A text whose white space is plain
is cut at it, words are looked up in a bounded cache, and only unseen words go through the library; any other text
goes through the library whole. Where the vocabulary drops white space, every text is cut at its ASCII white space and the
distinct words of many texts are looked up together, by the splitter's parts, which are fewer than words with their
punctuation; words of other characters, odd white space included, go through the library as they are. Ids are
little-endian unsigned 32-bit integers in one byte string.
"""

from __future__ import annotations

import codecs
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: White space to Unicode (or to Python, \x1c-\x1f) beyond the ASCII characters at which texts are cut.
ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
#: What a line-wise cut can't express: marks used below, other ASCII white space, and runs of white space.
UNEVEN = re.compile("[\x01\x02\t\x0b\x0c\r]| [ \n]|\n |\n\n\n|\n\n\\Z")
#: ASCII and the Latin-1 letters, where Python's letter, digit and case tables are the library's.
SIMPLE = re.compile("[!-~\xc0-\xd6\xd8-\xf6\xf8-\xff]+\\Z")
KEPT, LONG = 700_000, 64  # distinct words that a worker remembers; characters of the longest that is remembered for itself, of words with others
SLICE, TOGETHER = 8 << 20, 1 << 13  # bytes of texts encoded at a time; unseen parts sent to the library in one call
END = b"\xff" * 4  # stands for a line break between words


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """``ids(text)``: the ids of a text by a tokenizer file, as bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.lib = Tokenizer.from_file(path)
        self.lib.encode_special_tokens = True  # their strings in a text are ordinary text
        self.lowers = self.lib.normalizer is not None  # word_bpe: lower case, white space dropped
        self.model = self.lib.model
        self.words: dict[str, bytes] = _Cache(self)
        # byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in shown]
        self.alphabet = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
        if self.lowers:
            self.split = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xe0-\xf6\xf8-\xff\xdf]+|[0-9]|[^a-z\xdf-\xf6\xf8-\xff0-9\n]+|\n")
            # the same merges, for parts that are cut and spelt in the alphabet already
            self.cut = Tokenizer(self.model)
            self.cut.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            self.spelt = "".join([" " if b == 32 else self.alphabet[b] for b in range(256)])
            vocabulary = self.lib.get_vocab(with_added_tokens=False)
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # the ids that end a part
            self.last[[i for x, i in vocabulary.items() if x.endswith("</w>")]] = True
        else:
            self.split = re.compile("'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+| ?[0-9]+"
                                    "| ?[^ A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff0-9]+")

    def whole(self, text: str) -> bytes:
        return _pack(self.lib.encode(text, add_special_tokens=False).ids)

    def piece(self, text: str) -> bytes:
        """Ids of one cut-out word; simple ones skip the library's normaliser and splitter, not its merges."""
        if not text:
            return b""
        bare = text[1:] if text[:1] == " " else text
        if not SIMPLE.match(bare):
            return self.whole(text)
        table = self.alphabet
        out: list[int] = []
        for part in self.split.findall(text.lower() if self.lowers else text):
            mapped = part if part.isascii() and part[0] != " " else "".join([table[b] for b in part.encode()])
            out += [t.id for t in self.model.tokenize(mapped)]
        return _pack(out)

    def entry(self, key: str) -> bytes:
        if self.lowers:
            return END if key == "\n" else self.piece(key)
        if key[:1] == "\x02":  # the first word of a text
            return self.piece(key[1:])
        if key[:1] == "\x01":  # a line break and the word after it
            return self.piece("\n") + (self.entry(key[1:] if key[1:2] == "\x01" else "\x02" + key[1:]))
        return self.piece(" " + key)

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if ODD_SPACE.search(text):
            return self.whole(text)
        if self.lowers:
            return b"".join(map(self.words.__getitem__, text.split()))
        if UNEVEN.search(text):
            return self.whole(text)
        return b"".join(map(self.words.__getitem__, ("\x02" + text.replace("\n", " \x01")).split(" ")))

    def many(self, texts: pa.Array) -> list[bytes]:
        """:meth:`ids` of several texts."""
        out = []
        for ids, ends in self.slices(texts):
            raw, to = ids.tobytes(), (4 * ends).tolist()
            out += [raw[a:b] for a, b in zip([0, *to], to)]
        return out

    def slices(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, ends): the ids of a slice's texts one after the other and where each text's end, slice by slice; where
        white space is dropped, a slice's distinct words are looked up together."""
        size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)) // SLICE
        cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), len(texts)]
        for lo, hi in zip(cuts, cuts[1:]):
            some = texts.slice(lo, hi - lo)
            if self.lowers:
                yield self._slice(some.cast(pa.large_string()))
            else:
                raw = list(map(self.ids, some.to_pylist()))
                yield np.frombuffer(b"".join(raw), "<u4"), np.cumsum([len(x) // 4 for x in raw], dtype=np.int64)

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.ascii_split_whitespace(texts)  # no word, token or normal form crosses it; white space at a text's ends leaves empty words
        words = split.flatten().dictionary_encode()
        got = self._words(words.dictionary).take(words.indices)
        at = np.frombuffer(got.buffers()[1], np.int64)[got.offset:got.offset + len(got) + 1] // 4
        ids = np.frombuffer(got.buffers()[2] or b"", "<u4")[at[0]:at[-1]]
        return ids, (at - at[0])[split.offsets.to_numpy()[1:]]

    def _words(self, words: pa.Array) -> pa.Array:
        """The ids of each of some distinct words, as bytes."""
        simple = pc.match_substring_regex(words, f"\\A{SIMPLE.pattern[:-2]}\\z")
        cut = words.filter(simple)
        lines = pc.binary_join(pa.ListArray.from_arrays([0, len(cut)], cut), pa.scalar("\n", pa.large_string()))[0].as_py()
        found = self.learn(self.split.findall(f"{lines}\n".lower() if len(cut) else ""))
        for x in self._others(words.filter(pc.invert(simple)).to_pylist()):
            found += x, END
        ids = np.frombuffer(b"".join(found), "<u4")
        end = ids == 0xFFFFFFFF
        ends = np.flatnonzero(end)
        offsets = np.zeros(len(words) + 1, np.int64)
        offsets[1:] = 4 * (ends - np.arange(len(ends)))
        out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(ids[~end])])
        if len(cut) == len(words):
            return out
        place = np.empty(len(words), np.int64)  # simple words come first
        place[np.argsort(~simple.to_numpy(zero_copy_only=False), kind="stable")] = np.arange(len(words))
        return out.take(pa.array(place))

    def _others(self, words: list[str]) -> list[bytes]:
        """The ids of words that are not simple; long ones, such as lines without plain white space, aren't kept."""
        new = [x for x in words if len(x) <= LONG and x not in self.words]
        for lo in range(0, len(new), TOGETHER // 8):
            some = new[lo:lo + TOGETHER // 8]
            self.words.update(zip(some, [_pack(x.ids) for x in self.lib.encode_batch_fast(some, add_special_tokens=False)]))
        return [self.words[x] if len(x) <= LONG else self.whole(x) for x in words]

    def learn(self, parts: list[str]) -> list[bytes]:
        """The ids of each of the parts of simple words; unseen ones are encoded together and kept."""
        if len(self.words) >= KEPT:
            self.words.clear()
        self.words["\n"] = END
        found = list(map(self.words.get, parts))
        missing = [i for i, x in enumerate(found) if x is None]
        new = list(dict.fromkeys([parts[i] for i in missing]))
        for lo in range(0, len(new), TOGETHER):
            some = new[lo:lo + TOGETHER]
            spelt = codecs.charmap_decode(" ".join(some).encode(), "strict", self.spelt)[0]
            ids = np.array(self.cut.encode_batch_fast([spelt], add_special_tokens=False)[0].ids, "<u4")
            ends, raw = (4 * np.flatnonzero(self.last[ids]) + 4).tolist(), ids.tobytes()
            if len(ends) == len(some):  # else they come one by one
                self.words.update(zip(some, [raw[a:b] for a, b in zip([0, *ends], ends)]))
        for i in missing:
            found[i] = self.words[parts[i]]
        return found


class _Cache(dict):
    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, key: str) -> bytes:
        if len(self) >= KEPT:
            self.clear()
        out = self[key] = self.encoder.entry(key)
        return out


_MADE: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _MADE:
        _MADE[path] = Encoder(path)
    return _MADE[path]
