"""Conversation repair against an exhaustive search and a shortest-path search that share nothing with the alignment."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from tidemark.llm import turnrepair as T


def search(rows):
    """(cost, audit, repaired) by uniform-cost search over (row, state), least audit first: rows are (role, text, fault)."""
    heap = [(0, "", 0, "start", ())]
    seen = set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if i == len(rows) and state in ("start", "u"):
            return cost, audit, out
        if (i, state) in seen:
            continue
        seen.add((i, state))
        want = "a" if state == "a" else "u"
        after = "u" if want == "a" else "a"
        name = {"u": "user", "a": "assistant"}[want]
        heapq.heappush(heap, (cost + 2, audit + "I", i, after, (*out, (name, ""))))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, out))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                heapq.heappush(heap, (cost + 2 + extra, audit + "R", i + 1, after, (*out, (name, text))))
                if role[:1] == want:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, after, (*out, (role, text))))
                if role[:1] == "s" and state == "start":
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, "must", (*out, (role, text))))
    raise AssertionError


SPACE = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(SPACE)
        out.append((role, text, "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""))
        seen.add((role, text))
    return out


def brute(table):
    """Every column of op11 in plain Python."""
    convs: dict = {}
    for conv, turn, role, text in table:
        rows = convs.setdefault(conv, [])
        show = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        if kind:
            rows += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        f = faults([r[1:] for r in rows])
        cost, audit, fixed = search(f)
        turns = {r[0] for r in rows} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        sha = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in fixed).encode()).hexdigest()
        out.append((conv, gaps, *(sum(x[2] == k for x in f) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha))
    return sorted(out, key=str)


def run(spark, table):
    df = spark.createDataFrame([(*r, "x", 5) for r in table], "conv_id long, turn long, role string, text string, conv string, fault int")
    return sorted((tuple(r) for r in T.op11(df).collect()), key=str)


def codes(rows):
    number = {"": T.NONE, "blank": T.BLANK, "duplicate": T.DUPLICATE, "truncated": T.TRUNCATED}
    return b"".join(T.CODES.get((r[0][:1], number[r[2]])) or T.CODES["", number[r[2]]] for r in rows)


def test_all_short_conversations():
    """Every sequence of up to four rows over roles and faults."""
    kinds = [(r, "x", f) for r in ("user", "assistant", "system", "tool") for f in ("", "truncated", "blank")]
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n):
            cost, audit, _ = search(rows)
            assert T.repair_audit(codes(rows)) == (cost, audit), rows


@pytest.mark.parametrize("piece", [1, 2, 5, 128])
def test_random_conversations_in_pieces(monkeypatch, piece):
    monkeypatch.setattr(T, "PIECE", piece)
    rnd = random.Random(piece)
    for _ in range(400):
        n = rnd.choice([3, 6, 9, 14, 30])
        rows = [(rnd.choice(["user", "assistant", "user", "assistant", "system", "", "bot"]), "x", rnd.choice(["", "", "", "truncated", "blank", "duplicate"]))
                for _ in range(n)]
        if rnd.random() < 0.5:
            rows = [(("user", "assistant")[i % 2] if rnd.random() < 0.8 else r, t, f) for i, (r, t, f) in enumerate(rows)]
        if rnd.random() < 0.3:
            rows = [("system", "x", "blank")] * rnd.randrange(4) + [("system", "x", "")] + rows
        cost, audit, _ = search(rows)
        assert T.repair_audit(codes(rows)) == (cost, audit), rows


def test_tables_against_brute_force(spark):
    rnd = random.Random(1)
    texts = ["Yes.", "no", "", None, " \t", "Why? ", "a\nb!", "Yes. ", "long " * 300 + "."]
    roles = ["user", "assistant", "system", None, "", "tool", "unknown"]
    table = [(c, t if rnd.random() < 0.9 else None, rnd.choice(roles[:2] + roles[:2] + roles), rnd.choice(texts) if rnd.random() < 0.5 else f"text {c} {t}.")
             for c in [*range(120), None] for t in range(rnd.randrange(1, 9))]
    table += [(500, 3, "user", "same."), (500, 3, "user", "same."), (500, 3, "assistant", "same."), (501, None, None, None), (502, 7, "user", "Hi.")]
    table += [(600, t, ("user", "assistant")[t % 2], f"turn {t % 50}.") for t in range(700)]
    assert run(spark, table) == brute(table)
    assert run(spark, table[:0]) == []
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert run(spark, [(gone, 0, "user", "x")]) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_given_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    want = brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    assert sorted((tuple(r) for r in T.op11(df).collect()), key=str) == want


def test_long_texts_take_the_second_pass(spark):
    """More text than a task keeps: the digest of the streaming pass, and the repaired turns, equal the search's."""
    table = [(1, t, ("user", "assistant")[t % 3 % 2], ("x" * 3_000_000) + f" {t % 9}.") for t in range(12)]
    table += [(2, 0, "user", "Hi."), (2, 1, "assistant", "Yes.")]
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string").repartition(6)
    got = {r.conv_id: r for r in T.repair(df).collect()}
    turns = {}
    for r in T.repaired_turns(df).orderBy("conv_id", "position").collect():
        turns.setdefault(r.conv_id, []).append((r.edit, r.role, r.text))
    for conv in (1, 2):
        cost, audit, fixed = search(faults([r[2:] for r in table if r[0] == conv]))
        assert (got[conv].cost, got[conv].audit) == (cost, audit)
        assert got[conv].repaired_sha256 == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in fixed).encode()).hexdigest()
        assert [t[1:] for t in turns[conv]] == list(fixed)
        assert "".join(t[0] for t in turns[conv]) == audit.replace("D", "")
