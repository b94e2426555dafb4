"""The operators' algorithms against brute force, without Spark."""

import itertools
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import maxscore, mincut, neardup, orcids, packing, pitmanyor, pseudonyms, viterbi, wordcache, wordpiece
from tidemark.llm.groups import union
from tidemark.llm.wordcache import encoder

PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a", "B", " ", "  ", "\n", "\n\n", "'s", "é", "ß", "Σ", "1", "23", "!", "\t", "\xa0", "　", "\x1c", "<|endoftext|>", "中", "\x01"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cached_ids_equal_the_library(name):
    e, r = encoder(public_tokenizers.path(name)), random.Random(5)
    for _ in range(3000):
        t = "".join(r.choices(ODD, k=r.randint(0, 10)))
        assert e.ids(t) == e.whole(t), repr(t)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_texts_encoded_together_equal_the_library(name, monkeypatch):
    monkeypatch.setattr(wordcache, "SLICE", 100)
    e, r = wordcache.Encoder(public_tokenizers.path(name)), random.Random(6)
    for n in (0, 1, 5, 40):
        for _ in range(100):
            texts = ["".join(r.choices([*ODD, "", "\n", "ÿ", "</w>", "x" * 99], k=r.randint(0, n))) for _ in range(n)]
            e.words.clear()
            assert e.many(pa.array(texts, pa.string())) == [e.whole(t) for t in texts], repr(texts)


def test_unseen_words_go_through_the_library_once_and_together(monkeypatch):
    e, calls = wordcache.Encoder(public_tokenizers.path("word_bpe_49k.json")), []
    monkeypatch.setattr(e, "piece", calls.append)
    monkeypatch.setattr(e, "learn", lambda parts, learn=e.learn: calls.append(len(parts)) or learn(parts))
    texts = [f"word{'abcdefghij'[i % 10]}, WORD{'abcdefghij'[i % 7]}. word" for i in range(500)]
    assert e.many(pa.array(texts)) == list(map(e.whole, texts))
    assert len(calls) == 1 and len(e.words) == 10 + 3 + 1  # worda to wordj, word, "," and "."; line breaks


def test_odd_white_space_sends_only_its_own_word_to_the_library(monkeypatch):
    e, sent = wordcache.Encoder(public_tokenizers.path("word_bpe_49k.json")), []
    texts = [f"Plain words,{x}and more plain words" for x in ("\xa0", "\u2003", "\u3000", "\x85", "\x1c", " \xa0 ")] + ["\xa0" + "中" * 100]
    want = list(map(e.whole, texts))
    monkeypatch.setattr(e, "whole", lambda text, whole=e.whole: sent.append(text) or whole(text))
    assert e.many(pa.array(texts)) == want
    assert sent == texts[-1:] and texts[-1] not in e.words  # long words are not kept


@pytest.mark.parametrize("size", [1, 40, 10**6])
def test_rows_of_a_file_count_on_over_slices_and_batches(size, monkeypatch):
    monkeypatch.setattr(wordcache, "SLICE", size)
    e, r = wordcache.Encoder(public_tokenizers.path("word_bpe_49k.json")), random.Random(7)
    texts = ["", *("".join(r.choices(ODD, k=r.randint(0, 30))) for _ in range(50)), ""]
    keys = [None, *range(1, len(texts))]
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[a:b], pa.int64()), pa.array(texts[a:b], pa.string())], names=["doc_id", "text"])
               for a, b in ((0, 20), (20, 20), (20, len(texts)))]
    rows = [x for b in orcids.encoded(iter(batches), e, 2, 3) for x in b.to_pylist()]
    ids = [[*np.frombuffer(e.whole(t), "<u4").tolist(), 2] for t in texts]
    assert rows == [{"doc_id": k, "ids": x, "n_tokens": len(x), "part": 3, "before": sum(map(len, ids[:i]))} for i, (k, x) in enumerate(zip(keys, ids))]


def test_superminhash_is_the_minimum_over_permutations():
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 3, 40, 900)]
    whole = neardup.superminhash(sets, 32)
    assert (whole != 2**64 - 1).all()
    for i, s in enumerate(sets):  # a set's signature is the minimum of its elements' own full signatures
        each = np.stack([neardup.superminhash([s[k:k + 1]], 32)[0] for k in range(len(s))])
        assert (each.min(axis=0) == whole[i]).all()
        assert all(sorted((row >> np.uint64(32)).tolist()) == list(range(32)) for row in each)


def test_links_equal_exact_jaccard():
    r = np.random.default_rng(2)
    base = np.arange(60, dtype=np.uint64)
    sets = [np.unique(np.concatenate([r.choice(base, 55, replace=False), r.integers(100, 10**6, k).astype(np.uint64)])) for k in (0, 2, 5, 9) * 6]
    want = {(i, j) for i, j in itertools.combinations(range(len(sets)), 2)
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))}
    a, b = neardup.links_of(sets, None, 85, 100)
    assert {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist())} == want
    a, b = neardup.links_of(sets[:10], sets[10:], 85, 100)
    assert {(x, y + 10) for x, y in zip(a.tolist(), b.tolist())} == {p for p in want if p[0] < 10 <= p[1]}


def test_bands_miss_less_than_one_in_a_million():
    for t in (0.8, 0.85, 0.95):
        r, b = neardup.plan_bands(t)
        assert (1 - t**r) ** b <= 1e-6 and r * b <= 200


def test_union_gives_smallest_member():
    assert union(6, [5, 4, 1], [4, 2, 0]).tolist() == [0, 0, 2, 3, 2, 2]


@given(st.lists(st.floats(-3, 3), min_size=1, max_size=9), st.integers(0, 10**6))
@settings(max_examples=150, deadline=None)
def test_min_cut_is_optimal(scores, seed):
    r = random.Random(seed)
    edges = [(a, b, r.random() * 2) for a, b in itertools.combinations(range(len(scores)), 2) if r.random() < 0.5]
    cost = lambda side: sum(-s if k else 0 for s, k in zip(scores, side)) + sum(w for a, b, w in edges if side[a] != side[b])
    best = min(cost(side) for side in itertools.product([False, True], repeat=len(scores)))
    assert abs(cost(mincut.min_cut(scores, edges)) - best) < 1e-6


def test_main_text():
    page = ("<html><head><title>T</title><script>var a='</p>'</script></head><body><nav><ul><li><a href=/x>Home</a></ul></nav>"
            "<div class='cookie-notice'>We use cookies, accept them.</div><article><h1>Big   news</h1><p>One&amp;two,<br>three.<p><b>Next para."
            "</article><div id=comments><p>First! A reader comment, long enough to look like prose.</p></div><footer>&copy; x</footer>")
    assert mincut.main_text(page) == "Big news\nOne&two, three.\nNext para."
    assert [mincut.main_text(x) for x in (None, "", "  ", "<", "<p", "<!-- x")] == [""] * 6


@pytest.mark.parametrize("tag", ["svg", "title", "select", "object", "iframe", "noscript", "video", "template", "textarea"])
def test_text_after_an_unclosed_element_stays(tag):
    said = "The vote was close, and the mayor said so at length after the meeting, which went on until midnight."
    page = f"<body><article><h1>Big news</h1><p>{said}</p><{tag} class=x><p>Second: {said}</p></article></body>"
    assert mincut.main_text(page).endswith(f"Second: {said}")
    assert mincut.main_text(f"<p>{said}</p><script>if (a < b) {{ '<p>' + '{said}'") == said


def test_very_deep_pages_take_linear_time_and_keep_their_text():
    said = "A sentence of the story, long enough to count as prose, with commas and a full stop."
    start = time.time()
    text = mincut.main_text("<body><article>" + f"<div><p>{said}</p>" * 8000 + "</article>")
    assert text.count(said) == 8000 and time.time() - start < 30


STORY = "<article><h1>Big news</h1><p>" + "The council met on Monday, and it voted for the bridge. " * 8 + "</p></article>"
ASIDE = "A long and well written text, with commas, that reads like prose. " * 4


@pytest.mark.parametrize("part", [
    '<section class="comments"><article class="comment"><p>%s</p></article></section>',
    '<section class="comments"><article><p>%s</p></article></section>',
    '<article class="comment"><p>%s</p></article>', '<aside class="related"><article><p>%s</p></article></aside>',
    '<div hidden><article><p>%s</p></article></div>', '<div style="display:none"><main><p>%s</p></main></div>',
    '<div class="cookie-consent"><div class="content"><p>%s</p></div></div>', '<header class="promo"><p>%s</p></header>',
    '<main class="sidebar"><p>%s</p></main>'])
def test_boilerplate_holds_for_all_it_contains(part):
    want = mincut.main_text(STORY)
    assert want.startswith("Big news\nThe council")
    assert mincut.main_text(f"<body>{STORY}{part % ASIDE}</body>") == want


def test_comments_inside_a_longer_than_its_article():
    page = STORY.replace("</article>", f'<div class="comments"><article class="comment"><p>{ASIDE * 9}</p></article></div></article>')
    assert mincut.main_text(page) == mincut.main_text(STORY)


@pytest.mark.parametrize("wrap", ['<div class="page-with-sidebar">%s</div>', '<form id="aspnetForm">%s</form>', '<main class="has-sidebar">%s</main>'])
def test_wrappers_of_the_page_and_own_headers_do_not_count(wrap):
    assert mincut.main_text(wrap % STORY) == mincut.main_text(STORY)
    own = STORY.replace("<article>", '<article class="post has-sidebar"><header class="entry-header">').replace("</h1>", "</h1></header>")
    assert mincut.main_text(own) == mincut.main_text(STORY)


def test_maxscore_equals_brute_force():
    r = np.random.default_rng(3)
    for n, d in ((5, 3), (300, 8), (900, 16)):
        x = r.integers(-9, 9, (n, d)).astype(float)
        ids = r.permutation(n)
        cols = np.ascontiguousarray(x.T)
        for i in range(0, n, 7):
            got = maxscore.maxscore(x[i], ids[i], ids, cols, cols.max(axis=1), cols.min(axis=1), x[i] @ cols[:, :64], 20)
            s = x @ x[i]
            want = sorted((j for j in range(n) if j != i), key=lambda j: (-s[j], ids[j]))[:20]
            assert got[0].tolist() == [ids[j] for j in want] and got[1].tolist() == [s[j] for j in want]


def test_linear_match_equals_greedy():
    starts, inner = ["a", "ab", "abcd", "b"], ["c", "cd", "d", "da", "b"]
    m = wordpiece.LinearMatch(starts, inner)

    def greedy(w):
        i = n = 0
        while i < len(w):
            j = next((j for j in range(len(w), i, -1) if w[i:j] in (starts if i == 0 else inner)), 0)
            if not j:
                return -1
            i, n = j, n + 1
        return n

    for k in range(7):
        for w in itertools.product("abcd", repeat=k):
            assert m.count("".join(w)) == greedy("".join(w)), w


def test_viterbi_equals_dynamic_program_and_round_trips():
    m, r = viterbi.model(PIECES), random.Random(1)
    score = {p: s for p, (_, s, _) in m.machine.items()}

    def best(t):
        out = [0.0] + [float("-inf")] * len(t)
        for e in range(1, len(t) + 1):
            for b in range(max(0, e - 20), e):
                if t[b:e] in score:
                    out[e] = max(out[e], out[b] + score[t[b:e]])
            if t[e - 1] not in m.chars:
                out[e] = max(out[e], out[e - 1] + m.penalty)
        return out[-1]

    for _ in range(300):
        t = "".join(r.choices(["a", "the", " ", "  ", "\n", "é", "中", "😀", "ing", "\t", "\x01"], k=r.randint(0, 8)))
        ids = np.frombuffer(m.encode(t), "<u4").tolist()
        assert m.decode(tuple(ids)) == t
        if t and t.isascii() and not set(t) & set("\n\t\x01"):
            got = sum(score[m.pieces[i]] for i in ids)
            assert abs(got - best(viterbi.MARK + t.replace(" ", viterbi.MARK))) < 1e-6


def test_pseudonyms_keep_format_and_link():
    f = pseudonyms.Feistel(b"k")
    assert sorted(f.permute(i, 777, "x") for i in range(777)) == list(range(777))
    text = "card 4279055890764913 or 4279 0558 9076 4913, +1 (456) 555-2186, a.b@c.org, 2024-02-29, 123-45-6789, 67.190.110.215."
    new, kinds = pseudonyms.replace(text, f)
    assert kinds == ["card", "card", "phone", "email", "date", "ssn", "ip"]
    cards = re.findall(r"\d{4} ?\d{4} ?\d{4} ?\d{4}", new)
    assert cards[0] == cards[1].replace(" ", "") != "4279055890764913" and pseudonyms.luhn(cards[0])
    for clean in ("version 4.0. of 1234567890123456, 2023-02-30 and 000-12-3456", "", "no numbers"):
        assert pseudonyms.replace(clean, f) == (clean, [])


def test_a_secret_whose_digit_comes_late_is_found():
    f = pseudonyms.Feistel(b"k")
    for value in ("a" * 70 + "7", "Ab-_/+" * 400 + "3x", "abcdefg1"):
        new, kinds = pseudonyms.replace(f"api_key={value}, and more", f)
        assert kinds == ["secret"] and value not in new and len(new) == len(value) + 18
    assert pseudonyms.replace("password: " + "a" * 5000, f)[1] == []


def test_phones_and_addresses_outside_the_assigned_ranges_are_replaced():
    f = pseudonyms.Feistel(b"k")
    values = ["+1 (017) 555-7713", "+1 (132) 555-1352", "(555) 055-1234", "012-345-6789", "0.1.2.3", "127.0.0.1", "233.254.104.120", "248.40.198.62"]
    new = [pseudonyms.replace(f"at {v}, or", f) for v in values]
    assert [k for _, k in new] == [["phone"]] * 4 + [["ip"]] * 4
    for v, (t, _) in zip(values, new):
        got = t[3:-4]
        assert got != v and pseudonyms.FOUND.fullmatch(got)
        assert pseudonyms.replace(f"at {v}, or", f)[0] == t
        if v[0] == "+":
            assert re.sub(r"\d", "0", got[1:]) == re.sub(r"\d", "0", v[1:])
    small = [pseudonyms.alike(x, 1000, "x", lambda y: y >= 200, f) for x in range(1000)]
    assert sorted(small) == list(range(1000)) and max(small[:200]) < 200
    assert pseudonyms.replace("1.2.3.256", f) == ("1.2.3.256", [])
    for phone in ("+1 (826) 555-4081", "+44 20 7946 0958"):  # the address after a number isn't part of it
        new, kinds = pseudonyms.replace(f"{phone} 190.137.223.204", f)
        assert kinds == ["phone", "ip"] and new.startswith(pseudonyms.replace(phone, f)[0] + " ")


def test_nnls_combinations_fill_windows_and_stay_within_the_histogram():
    hist = {3: 50, 5: 50, 2: 31}
    used = {}
    for c, k in packing.solve(hist, 8):
        assert sum(c) == 8
        for n in c:
            used[n] = used.get(n, 0) + k
    left = {n: k - used.get(n, 0) for n, k in hist.items()}
    assert min(left.values()) >= 0 and used
    for c in packing.combinations(np.array(sorted(hist)), 8):  # maximal: nothing more can be granted
        assert any(left[n] < c.count(n) for n in c)


def test_seating_bounds():
    c = np.array([0, 1, 2, 9, 12, 13, 5000])
    t = pitmanyor.seat(c, np.full(7, 0.5), 0.7, np.arange(7).astype(np.uint64), 1)
    assert ((t >= np.minimum(c, 1)) & (t <= c)).all() and zlib.crc32(t.tobytes()) == zlib.crc32(
        pitmanyor.seat(c, np.full(7, 0.5), 0.7, np.arange(7).astype(np.uint64), 1).tobytes())


def test_seats_follow_the_conditional_of_a_dish():
    """Tables of a dish of 4 customers against all its seatings, for dishes taken together and for the largest ones alone;
    the seating is kept: with next to no weight on new tables, tables only close slowly and none is opened."""
    d, f, n = 0.4, 0.7, 4000

    def weight(sizes):
        return f ** len(sizes) * np.prod([np.prod([k - d for k in range(1, s)]) for s in sizes])

    def seatings(i, sizes):
        if i == 4:
            yield sizes
            return
        for k in range(len(sizes)):
            yield from seatings(i + 1, [*sizes[:k], sizes[k] + 1, *sizes[k + 1:]])
        yield from seatings(i + 1, [*sizes, 1])

    want = np.zeros(5)
    for x in seatings(0, []):
        want[len(x)] += weight(x)
    want /= want.sum()
    c = np.full(n, 4)
    s = pitmanyor.Seats(c, d, np.arange(n).astype(np.uint64))
    for i in range(8):
        s.sweep(i, np.full(n, f), np.zeros(n))
    assert abs(np.bincount(s.t, minlength=5) / n - want).max() < 0.04
    alone = np.zeros(5)
    for b in range(40):
        s = pitmanyor.Seats(np.full(40, 4), d, np.arange(40).astype(np.uint64) + np.uint64(1000 * b))
        for i in range(8):
            s.sweep(i, np.full(40, f), np.zeros(40))
        alone += np.bincount(s.t, minlength=5)
    assert abs(alone / alone.sum() - want).max() < 0.06
    big = pitmanyor.Seats(np.full(200, 300), d, np.arange(200).astype(np.uint64))
    big.sweep(1, np.full(200, 5.0), np.zeros(200))
    before = big.t.copy()
    again = pitmanyor.Seats(np.full(200, 300), d, np.arange(200).astype(np.uint64))
    again.load(big.table)
    assert (again.size == big.size).all() and (again.t == big.t).all()
    big = again  # written and read between sweeps
    big.sweep(2, np.full(200, 1e-9), np.zeros(200))
    assert (big.t <= before).all() and (big.t > 1).any()
    for k in range(200):
        a, m = big.off[k], int(big.c[k])
        z = big.table[a:a + m]
        assert (np.bincount(z, minlength=m) == big.size[a:a + m]).all() and len(set(z.tolist())) == big.tab[k]


def test_a_context_is_the_whole_previous_word():
    words = pitmanyor.Words()
    keys, starts = pitmanyor.coded(words, ["Überraschung folgt the überraschung".encode(), b"", b"folgt"])
    name = {i: w.decode() for w, i in words.items()}
    assert [(name[k & 0xFFFFFFFF], name[k >> 32]) for k in keys.tolist()] == [
        ("", "Überraschung"), ("Überraschung", "folgt"), ("folgt", "the"), ("the", "überraschung"), ("überraschung", ""), ("", ""),
        ("", "folgt"), ("folgt", "")]
    assert starts.tolist() == [0, 5, 6]
