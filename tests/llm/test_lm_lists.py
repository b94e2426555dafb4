"""Number lists, words and distinct pairs of the language model against plain Python."""

from collections import Counter

import numpy as np
import xxhash

from tidemark.llm import pitmanyor as lm

TEXTS = [b"", b" ", b"a  B\ta ", b"\xff\xfe x\x1cy \x0b\x0c z", "Über é x 　 Ü ü".encode(), b"\x00 \x00a", b"x" * 100_000 + b" y", b"a b a b"]


def test_integers_come_back():
    r = np.random.default_rng(0)
    for x in ([], [0], [5, -3, 2**61, -2**61], r.integers(-10**12, 10**12, 1000), np.sort(r.integers(0, 10**9, 1000))):
        for ordered in (False, True):
            assert (lm.spread(lm.squeeze(np.array(x, np.int64), ordered), ordered) == np.array(x, np.int64)).all()


def test_words_are_split_at_ascii_white_space():
    words = lm.Words()
    keys, starts = lm.coded(words, TEXTS)
    name = list(words)
    want = [[*t.lower().split(), b""] for t in TEXTS]
    assert [name[k >> 32] for k in keys.tolist()] == sum(want, [])
    assert starts.tolist() == np.cumsum([0, *map(len, want)])[:-1].tolist()
    assert [len(x) for x in lm.coded(lm.Words(), [])] == [0, 0]


def test_pairs_are_counted_and_found_again():
    words = lm.Words()
    keys, _ = lm.coded(words, TEXTS * 3)
    number = np.random.default_rng(1).permutation(len(words)).astype(np.int64) * 7
    train = np.arange(len(keys)) % 3 > 0
    w, u, q, n = lm.counted(number, keys, train, 5)
    pairs = [(int(number[k >> 32]), int(number[k & 0xFFFFFFFF])) for k in keys.tolist()]
    want = Counter(p for p, t in zip(pairs, train) if t)
    assert {(a, b): c for a, b, c in zip(w.tolist(), u.tolist(), n.tolist())} == {p: want[p] for p in set(pairs)}
    assert (np.diff(q) >= 0).all()
    at = lm.pairs_at(number, keys, 5)
    assert list(zip(w[at].tolist(), u[at].tolist())) == pairs


def test_seatings_come_back_from_the_sizes_of_tables():
    c = np.array([5, 1, 0, 300, 2, 40])
    s = lm.Seats(c, 0.6, np.arange(6).astype(np.uint64))
    s.sweep(1, np.full(6, 2.0), np.zeros(6))
    again = lm.Seats(c, 0.6, np.arange(6).astype(np.uint64))
    again.seated(s.tab, s.sizes())
    assert (again.t == s.t).all() and (again.sizes() == s.sizes()).all()
    again.sweep(2, np.full(6, 2.0), np.zeros(6))
    for k, (a, m) in enumerate(zip(again.off, again.c)):
        assert again.sizes()[again.tab[:k].sum():again.tab[:k + 1].sum()].sum() == m == np.bincount(again.table[a:a + m]).sum()


def test_distinct_numbers_and_their_positions():
    r = np.random.default_rng(2)
    for x in ([], [7], r.integers(0, 50, 1000), r.integers(0, 2**62, 1000), np.repeat(r.integers(0, 2**40, 100), 9)):
        x = np.array(x, np.int64)
        for got, want in zip(lm.distinct(x), np.unique(x, return_inverse=True)):
            assert (got == want).all()


def test_texts_are_read_once_and_kept_as_tokens(spark):
    rows = [(None if i % 7 == 0 else i, None if i % 5 == 0 else f"Word{i % 3}  and\u3000{i}\t" * (i % 4) + "x y " * 2000) for i in range(200)]
    both = lm.staged(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert not any(t == "string" or t.endswith("<string>") for _, t in both.dtypes)
    kept = both.toArrow().sort_by([("chunk", "ascending"), ("piece", "ascending")])
    assert set(kept.column("chunk").to_pylist()) == {0} and kept.num_rows > 1
    keys, n = lm.tokens_of(kept)
    words = [[*(t or "").encode().lower().split(), b""] for _, t in rows]
    flat = sum(words, [])
    name = [xxhash.xxh3_64_intdigest(w) for w in flat]
    hashes = lm.hashes_of(kept)
    assert n.tolist() == list(map(len, words)) and hashes[keys >> 32].tolist() == name
    assert hashes[keys & 0xFFFFFFFF].tolist() == [xxhash.xxh3_64_intdigest(b""), *name[:-1]]
    assert [i for x in kept.column("doc_id").to_pylist() for i in x] == [i for i, _ in rows]
    assert sum(kept.column("size").to_pylist()) == sum(len(t.encode()) + 100 for _, t in rows if t is not None)
