"""Cross-tokenizer alignment against brute force by the two libraries alone."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import crossalign as C

FILES = C.Pair(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, True)
SLOW = C.Pair(FILES.a, FILES.b)
ODD = ["hello world, the tokenizer's end.", "hello world", "hello world", "", None, " ", "  two  spaces ", "tab\there\r\nnew\n\n\nlines \n", "a\x00b \x1c c\x85d\xa0e",
       "<|endoftext|> <s> </s> <unk> <0x41>", "lower ▁ bar", "naïve façade — “quoted” €5 1234567890", "日本語のテキスト。中文文本 한국어", "emoji 👩‍👩‍👧‍👦 🏳️‍🌈 𝔘𝔫𝔦", "x" * 3000,
       "=" * 1000 + " " * 900 + "-" * 401, "don't we'll I'M 'S", "ɏ‐‧", "é" * 700, "﻿bom ​ zero", "ab" * 600 + "\n" + "1" * 500]


def bytes_of_a(lib):
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {chr(b): b for b in shown}
    for b in range(256):
        if b not in shown:
            names[chr(256 + len(names) - len(shown))] = b
    return {i: bytes(names[c] for c in t) for t, i in lib.get_vocab().items() if set(t) <= set(names)}


def brute(rows):
    lib = Tokenizer.from_file(FILES.a)
    lib.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=FILES.b)
    a_bytes = bytes_of_a(lib)
    docs = []
    for _, text in rows:
        want = (" " + (text or "")).encode()
        a = lib.encode(" " + (text or ""), add_special_tokens=False).ids
        b = sp.encode(text or "")
        piece = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(piece) != want or b"".join(a_bytes[i] for i in a) != want:
            docs.append(None)
            continue
        groups, i, j, at, to = [([], [])], 0, 0, 0, 0
        while i < len(a) or j < len(b):
            if at <= to and i < len(a):
                at += len(a_bytes[a[i]])
                groups[-1][0].append(a[i])
                i += 1
            else:
                to += len(piece[j])
                groups[-1][1].append(b[j])
                j += 1
            if at == to:
                groups.append(([], []))
        docs.append(([g for g in groups if g[0]], len(a), len(b)))
    held = Counter()
    for d in docs:
        if d:
            held.update({(x, y) for g in d[0] for x in g[0] for y in g[1]})
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for (i, _), d in zip(rows, docs):
        if not d:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x, y) for g in d[0] for x in g[0] for y in g[1]]
        text = ";".join(f"{','.join(map(str, g[0]))}|{','.join(map(str, g[1]))}" for g in d[0])
        out.append((i, d[1], d[2], len(d[0]), len(links), sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(map(str, out))


def run(spark, rows, files=FILES, **more):
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, uid string, key int")
    return sorted(str(tuple(r)) for r in C.cross_alignment(df, files, **more).collect())


@pytest.fixture(scope="module")
def rows(spark):
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()
    odd = list(enumerate(ODD)) + [(7, "a repeated id"), (7, "a repeated id"), (None, "no id")]
    return odd + [(1000 + r.doc_id, r.text) for r in real]


def test_equals_brute_force(spark, rows):
    want = brute(rows)
    assert run(spark, rows) == want
    assert run(spark, rows, SLOW) == want


def test_quick_encoders_equal_the_libraries(spark):
    quick, slow = C.aligner(FILES), C.aligner(SLOW)
    assert quick.quick is not None
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()] + ODD
    words = "the it's of\n\nThe É été ßtraße Łódź ɏɏ 12,345.67 «x» ¿qué? a_b() == != \\frac{1}{2} http://x.y/z?q=1&r=2 ~~~~ ÆØÅ".split(" ")
    texts += [" ".join(words[(i * k) % len(words)] for i in range(40)) for k in range(1, 30)] + ["a ", "\n", "\n a", "a \nb", "a\n\n\n", "x" * 399, "x" * 400]
    plain = 0
    for t in texts:
        if t:
            plain += bool(C.PLAIN.match(t))
            x, y = quick.one(t.encode()), slow.one(t.encode())
            assert (x is None) == (y is None)
            assert x is None or (x.a.tolist() == y.a.tolist() and x.b.tolist() == y.b.tolist()), t
    assert plain > 900
    assert not any(C.PLAIN.match(t) for t in (" a", "a  b", "x" * 400, "\n" * 400, "a\tb", "▁"))


def test_tree_shards_and_dealt_lookups(spark, rows, monkeypatch):
    """Many shards, a tree of several levels, and look-ups by shuffle in place of a broadcast."""
    monkeypatch.setattr(C, "SHARD", 200)
    monkeypatch.setattr(C, "LEAF", 5)
    monkeypatch.setattr(C, "FAN", 3)
    assert run(spark, rows, broadcast=0) == run(spark, rows) == brute(rows)


def test_empty_and_tokenless_tables(spark):
    assert run(spark, [(1, "a")][:0]) == []
    for broadcast in (0, C.BROADCAST):
        assert run(spark, [(1, None), (2, "")], broadcast=broadcast) == ["(1, 0, 0, 0, 0, 0, 0, '')", "(2, 0, 0, 0, 0, 0, 0, '')"]


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 40_000])
def test_perfect_hash_is_minimal(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 48, n))
    seed, g = C.perfect_hash(keys)
    assert (g >= C.USED).sum() == len(keys) and len(g) <= 1.23 * n + 9
    v = C.vertices(keys, seed, len(g) // 3)
    place = C.Table(1, [{"shard": 0, "seed": seed, "g": g.tobytes(), "keys": b""}]).rank[v[np.arange(len(v)), (g[v] & 3).sum(axis=1) % 3]]
    assert sorted(place.tolist()) == list(range(len(keys)))


def test_strangers_are_refused():
    keys = np.arange(5, 500, 7)
    seed, g = C.perfect_hash(keys)
    v = C.vertices(keys, seed, len(g) // 3)
    t = C.Table(1, [{"shard": 0, "seed": seed, "g": g.tobytes(), "keys": b""}])
    order = np.empty_like(keys)
    order[t.rank[v[np.arange(len(v)), (g[v] & 3).sum(axis=1) % 3]]] = keys
    t = C.Table(1, [{"shard": 0, "seed": seed, "g": g.tobytes(), "keys": order.tobytes()}])
    assert (t.keys[t.places(keys)] == keys).all()
    with pytest.raises(ValueError):
        t.places(np.array([6]))


def test_wide_groups_count_by_distinct_ids(monkeypatch):
    by = C.aligner(FILES)
    x = by.align([("=" * 1111 + " word").encode()])[0]
    plain = x.pairs()
    monkeypatch.setattr(C, "WIDE", 0)
    wide = x.pairs()
    assert all((p == q).all() for p, q in zip(plain, wide)) and plain[1].sum() == x.links
