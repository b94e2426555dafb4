"""Token ids of whole texts by a byte-level BPE file, plain texts through the same vocabulary as ranks."""

from __future__ import annotations

import base64
import os
from dataclasses import dataclass

import numpy as np

from . import wordcache
from .crossalign import PLAIN

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer file of the ``tokenizers`` library, its vocabulary as ranks and its split pattern."""

    path: str
    ranks: str
    pattern: str


class RankEncoder:
    """``ids(text)``: the ids of a text as little-endian unsigned 32-bit integers. Texts that are not ``PLAIN`` go through the
    library; for the others ``tiktoken`` merges by the same ranks to the same ids, in a fraction of the time."""

    def __init__(self, vocabulary: Vocabulary):
        import tiktoken
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(vocabulary.path)
        self.lib.encode_special_tokens = True
        with open(vocabulary.ranks, "rb") as f:
            ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, f)}
        self.quick = tiktoken.Encoding("ranks", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        ids = self.quick.encode_ordinary(text) if PLAIN.match(text) else self.lib.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()


_MADE: dict[Vocabulary, RankEncoder] = {}


def encoder(tokenizer: str | Vocabulary):
    """The worker's encoder for a tokenizer file, or for one with its ranks."""
    if isinstance(tokenizer, str):
        return wordcache.encoder(tokenizer)
    if tokenizer not in _MADE:
        _MADE[tokenizer] = RankEncoder(tokenizer)
    return _MADE[tokenizer]
