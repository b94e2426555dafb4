"""Conversation structure repair: cheapest edits that make the roles of a conversation alternate.

A conversation's rows, by turn (nulls first; equal turns by role, then text), are aligned to the grammar
``(s?(ua)+)?`` over role initials. Keep costs 0, Rerole to user or assistant 2, Insert of an empty user or assistant turn 2, Delete
3. Blank rows (without a character ``[^\\x20\\x09-\\x0D]``) and duplicates (role and text seen earlier) must be deleted; an
undeleted truncated row (its last such character is not one of ``.!?``) adds 1. The audit is the string of edit initials; of the
cheapest audits the ASCII-least is taken.

*Alignment* (Wagner-Fischer). ``S[i][j]`` is the least cost of aligning the rows from i on with the last j symbols of the
alternating string; as the grammar ends in "ua", the last j symbols are the same for every target length, so one matrix holds
the distances of all feasible lengths. An incumbent (keep or rerole each row that may stay) bounds the cost; Ukkonen's bands drop
cells whose surplus of symbols (inserts) or rows (deletes) alone costs more. Every feasible length of least cost is traced and
the audits are compared. A leading system row is one more choice of where the string begins.

*Long conversations* are aligned in pieces of ``PIECE`` rows. Between pieces only what may come next matters (start, after a
system turn, user, assistant), so the costs of these four states are carried backwards over the pieces, and each piece is aligned
again, forwards, from the state its predecessor ended in. Inserts between two pieces belong to the later one, so no audit of a piece
is the beginning of another and the least audit is found piece by piece. Memory is one byte a row plus one piece.

*Spark.* One exchange by conversation. Duplicates are found by a window in the same partitioning (it spills), and rows stream
through Python in order: one code byte a row is kept, texts up to ``BUFFER`` bytes. A conversation with more text than that is
rewritten in a second streaming pass in which its audit comes first. A digest of a whole conversation is a sequential hash, so
a conversation is never split, but no task holds its texts.

Defined results: a null role or text is one space; rows with a null conversation id are one conversation, with a null id; null
turns come first and count in no gap; repeated rows are duplicates. Roles are told apart by their first character. Extra
columns are ignored. An empty table gives no rows. Texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ASCII_SPACE, map_arrow, materialize, partitions

PIECE = 128
BUFFER = 16 << 20
KEEP, REROLE, INSERT, DELETE, CUT = 0, 2, 2, 3, 1
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
INF = 1 << 60
#: what may come next: the start, a user turn that must come (after a system turn), a user turn or the end, an assistant turn
START, MUST, USER, ASSISTANT = range(4)
LAST = (0, INF, 0, INF)  # costs of being in these states at the end


class Piece:
    """Alignment of some consecutive rows, given as (initial, must go, extra cost), and the costs of the states after them."""

    def __init__(self, rows: list[tuple[str, bool, int]], after: tuple[int, ...], last: bool):
        self.rows, self.after, self.last, n = rows, after, last, len(rows)
        stay = [0] * (n + 1)  # rows from i on that need not go
        for i in range(n - 1, -1, -1):
            stay[i] = stay[i + 1] + (not rows[i][1])
        slack = self.incumbent() + 2 * INSERT - min(after) - DELETE * (n - stay[0])  # all states are that near each other
        self.lo = [max(0, k - slack // DELETE) for k in stay]
        self.hi = [k + slack // INSERT for k in stay]
        self.s = {q: self.matrix(q) for q in (USER, ASSISTANT) if after[q] < INF}
        self.least = [(DELETE * (n - i) + after[MUST], DELETE * (n - i) + after[START]) for i in range(n + 1)]
        self.must = [min([self.least[i][0], *(v for v, _, _ in self.targets(i))]) for i in range(n + 1)]
        start = min([self.least[0][1], *(v for v, _, _ in self.targets(0)), *(v for v, _ in self.systems())])
        ends = lambda parity: min([v for v, _, _ in self.targets(0, parity)], default=INF)
        self.before = (start, self.must[0], ends(0), ends(1))

    def incumbent(self) -> int:
        """Cost of keeping or reroling every row that may stay, from a user turn on."""
        cost, symbol = 0, "u"
        for c, must, more in self.rows:
            if must:
                cost += DELETE
            else:
                cost += more + (KEEP if c == symbol else REROLE)
                symbol = "a" if symbol == "u" else "u"
        q, other = (USER, ASSISTANT) if symbol == "u" else (ASSISTANT, USER)
        return cost + min(self.after[q], self.after[other] + INSERT)

    def matrix(self, q: int) -> list[list[int]]:
        """Banded rows of S for targets that end in state q; S[i][j - lo[i]]."""
        rows, lo, hi, odd = self.rows, self.lo, self.hi, q == ASSISTANT
        n = len(rows)
        out: list[list[int]] = [[]] * (n + 1)
        out[n] = [self.after[q] + INSERT * j if self.last or j == 0 else INF for j in range(lo[n], hi[n] + 1)]
        for i in range(n - 1, -1, -1):
            c, must, more = rows[i]
            below, a, b = out[i + 1], lo[i + 1], hi[i + 1]
            row, left = [], INF
            for j in range(lo[i], hi[i] + 1):
                v = below[j - a] + DELETE if a <= j <= b else INF
                if not must and a < j <= b + 1:
                    w = below[j - 1 - a] + more + (KEEP if c == ("a" if (j + odd) % 2 else "u") else REROLE)
                    v = min(v, w)
                left = min(v, left + INSERT)
                row.append(left)
            out[i] = row
        return out

    def at(self, q: int, i: int, j: int) -> int:
        return self.s[q][i][j - self.lo[i]] if self.lo[i] <= j <= self.hi[i] else INF

    def targets(self, i: int, parity: int | None = None) -> list[tuple[int, int, int]]:
        """(cost, state after the piece, length) of every feasible target from row i on, whose first symbol is a user turn and that
        isn't empty; with ``parity`` 0 also the empty one, with 1 those whose first symbol is an assistant turn."""
        out = []
        for q in self.s:
            odd = q == ASSISTANT
            for j in range(self.lo[i], self.hi[i] + 1):
                if (j + odd) % 2 == (parity or 0) and (j or parity is not None):
                    v = self.at(q, i, j)
                    if v < INF:
                        out.append((v, q, j))
        return out

    def systems(self) -> list[tuple[int, int]]:
        """(cost, row) of keeping a system row as the first turn."""
        return [(DELETE * i + more + self.must[i + 1], i) for i, (c, must, more) in enumerate(self.rows) if c == "s" and not must]

    def trace(self, q: int, i: int, j: int) -> str:
        """ASCII-least audit of one target."""
        n, out, odd = len(self.rows), [], q == ASSISTANT
        while i < n or j:
            v = self.at(q, i, j)
            if i < n and self.at(q, i + 1, j) + DELETE == v:
                out.append("D")
                i += 1
            elif j and self.at(q, i, j - 1) + INSERT == v:
                out.append("I")
                j -= 1
            else:
                c, _, more = self.rows[i]
                kept = c == ("a" if (j + odd) % 2 else "u") and self.at(q, i + 1, j - 1) + more + KEEP == v
                out.append("K" if kept else "R")
                i, j = i + 1, j - 1
        return "".join(out)

    def audits(self, state: int, i: int = 0) -> list[tuple[str, int]]:
        """(audit, state after the piece) of every target of least cost from row i on in a state."""
        n = len(self.rows)
        parity = {USER: 0, ASSISTANT: 1}.get(state)
        best = self.must[i] if state == MUST else self.before[state]
        out = [(self.trace(q, i, j), q) for v, q, j in self.targets(i, parity) if v == best]
        if state in (MUST, START) and self.least[i][state == START] == best:
            out.append(("D" * (n - i), state))
        if state == START:
            for v, k in self.systems():
                if v == best:
                    out += [("D" * k + "K" + a, q) for a, q in self.audits(MUST, k + 1)]
        return out


CODES = {(c, f): bytes([4 * k + f]) for k, c in enumerate(("u", "a", "s", "")) for f in range(4)}
ROWS = {v[0]: (c, f in (BLANK, DUPLICATE), CUT * (f == TRUNCATED)) for (c, f), v in CODES.items()}


def repair_audit(codes: bytes) -> tuple[int, str]:
    """(cost, audit) of a conversation given as one code a row."""
    if not codes:
        return 0, ""
    cuts = range(0, len(codes), PIECE)
    after: list[tuple[int, ...]] = [LAST]
    only: Piece | None = None
    for lo in reversed(cuts):
        only = Piece([ROWS[c] for c in codes[lo:lo + PIECE]], after[-1], lo + PIECE >= len(codes))
        after.append(only.before)
    cost = after[-1][START]
    if len(cuts) == 1:
        return cost, min(only.audits(START))[0]
    out, state = [], START
    for k, lo in enumerate(cuts):
        piece = Piece([ROWS[c] for c in codes[lo:lo + PIECE]], after[-2 - k], lo + PIECE >= len(codes))
        audit, state = min(piece.audits(state))
        out.append(audit)
    return cost, "".join(out)


class Rewriter:
    """Applies an audit to the rows of a conversation, in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.role = audit, 0, "user"

    def inserts(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield "I", *self.turn(self.role, "")

    def turn(self, role: str, text: str) -> tuple[str, str]:
        self.role = "assistant" if role[:1] == "u" else "user"
        return role, text

    def feed(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of the turns up to and with this row."""
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield edit, *self.turn(role if edit == "K" else self.role, text)


class Digest:
    """sha256 of ``role:text`` lines."""

    def __init__(self) -> None:
        self.sha, self.first = hashlib.sha256(), True

    def add(self, turns: Iterator[tuple[str, str, str]]) -> None:
        for _, role, text in turns:
            self.sha.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
            self.first = False


def ordered(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows (conv, turn, role, text, fault), in order within partitions by conversation."""
    rows = turns.select(F.col(conv_id).alias("conv"), F.col(turn).cast("long").alias("turn"),
                        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    rows = rows.repartition(partitions(rows), "conv")
    again = F.row_number().over(Window.partitionBy("conv", "role", "text").orderBy(F.asc_nulls_first("turn"))) > 1
    body = F.rtrim("text", F.lit(ASCII_SPACE))
    cut = ~F.substring(body, -1, 1).isin(".", "!", "?")
    fault = F.when(body == "", BLANK).when(F.col("again"), DUPLICATE).when(cut, TRUNCATED).otherwise(NONE)
    rows = rows.withColumn("again", again).select("conv", "turn", "role", "text", fault.alias("fault"))
    # of equal rows the first is the original
    return rows.sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text", "fault")


def streamed(batches: Iterator[pa.RecordBatch], start: Callable, feed: Callable, end: Callable) -> Iterator:
    """start(conv), feed(state, row) and end(state) over the consecutive rows of each conversation."""
    state = last = None
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if state is None or row[0] != last:
                if state is not None:
                    yield end(state)
                last = row[0]
                state = start(last)
            feed(state, row)
    if state is not None:
        yield end(state)


class Conversation:
    """What one pass over the rows of a conversation gathers."""

    def __init__(self, conv: object):
        self.conv = conv
        self.codes = bytearray()
        self.faults = [0] * 4
        self.first = self.last = None
        self.distinct = self.illegal = self.bytes = 0
        self.before: str | None = None
        self.rows: list[tuple[str, str]] | None = []

    def feed(self, row: tuple) -> None:
        _, turn, role, text, fault = row
        c = role[:1]
        self.codes += CODES.get((c, fault)) or CODES["", fault]
        self.faults[fault] += 1
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.distinct += 1
        if self.before is not None and self.before + c not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = c
        if self.rows is not None:
            self.rows.append((role, text))
            self.bytes += len(role) + len(text) + 100
            if self.bytes > BUFFER:
                self.rows = None

    def result(self) -> dict:
        cost, audit = repair_audit(bytes(self.codes))
        sha = None
        if self.rows is not None:
            digest, rewriter = Digest(), Rewriter(audit)
            for role, text in self.rows:
                digest.add(rewriter.feed(role, text))
            digest.add(rewriter.inserts())
            sha = digest.sha.hexdigest()
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return {"conv": self.conv, "gaps": gaps, "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE],
                "truncated": self.faults[TRUNCATED], "illegal": self.illegal, "cost": cost, "audit": audit, "sha": sha}


def batches_of(rows: Iterator[dict], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    size = 0
    for r in rows:
        held.append(r)
        size += sum(len(x) for x in r.values() if isinstance(x, str))
        if len(held) == 2000 or size > 1 << 22:
            yield pa.RecordBatch.from_arrays([pa.array([h[n] for h in held], t) for n, t in zip(names, types)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([h[n] for h in held], t) for n, t in zip(names, types)], names=names)


FOUND = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def audited(rows: DataFrame) -> DataFrame:
    """Per conversation of ``ordered`` rows: conv, the counts, cost, audit and sha (null: too long to be rewritten in passing)."""
    conv = rows.schema["conv"].dataType
    names = ["conv", *FOUND, "audit", "sha"]
    kind = pa.int64() if conv.simpleString() == "bigint" else pa.string()
    types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(streamed(batches, Conversation, Conversation.feed, Conversation.result), names, types)

    return map_arrow(rows, run, f"conv {conv.simpleString()}, {', '.join(f'{c} long' for c in FOUND)}, audit string, sha string")


def beside(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv, audit, role, text): the audit of each conversation in ``audits`` before its rows, in order."""
    wanted = audits.select(F.col("conv").alias("c"))
    mine = rows.join(wanted, F.col("conv").eqNullSafe(F.col("c")), "left_semi").select(
        "conv", F.lit(1).alias("side"), "turn", "role", "text", "fault", F.lit(None).cast("string").alias("audit"))
    head = audits.select("conv", F.lit(0).alias("side"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                         F.lit("").alias("text"), F.lit(0).alias("fault"), "audit")
    both = head.unionAll(mine)
    both = both.repartition(partitions(both), "conv").sortWithinPartitions("conv", "side", F.asc_nulls_first("turn"), "role", "text", "fault")
    return both.select("conv", "audit", "role", "text")


class Late:
    """Digest of a conversation whose audit comes before its rows."""

    def __init__(self, conv: object):
        self.conv, self.digest, self.rewriter = conv, Digest(), Rewriter("")

    def feed(self, row: tuple) -> None:
        if row[1] is not None:
            self.rewriter = Rewriter(row[1])
        else:
            self.digest.add(self.rewriter.feed(row[2], row[3]))

    def result(self) -> dict:
        self.digest.add(self.rewriter.inserts())
        return {"conv": self.conv, "late": self.digest.sha.hexdigest()}


def repair(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    told = _told(ordered(_keyed(turns, conv_id), conv_id, turn, role, text))
    return told.select(F.col("conv").alias(conv_id), *FOUND, "audit", F.col("sha").alias("repaired_sha256"))


def _keyed(turns: DataFrame, conv_id: str) -> DataFrame:
    """Ids of other types than long as strings."""
    return turns if turns.schema[conv_id].dataType.simpleString() == "bigint" else turns.withColumn(conv_id, F.col(conv_id).cast("string"))


def _told(rows: DataFrame) -> DataFrame:
    told = materialize(audited(rows))
    late = told.where("sha is null")
    if late.isEmpty():
        return told
    conv = rows.schema["conv"].dataType.simpleString()
    kind = pa.int64() if conv == "bigint" else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(streamed(batches, Late, Late.feed, Late.result), ["conv", "late"], [kind, pa.string()])

    shas = map_arrow(beside(rows, late.select("conv", "audit")), run, f"conv {conv}, late string").withColumnRenamed("conv", "c")
    return told.join(shas, F.col("conv").eqNullSafe(F.col("c")), "left").withColumn("sha", F.coalesce("sha", "late")).drop("c", "late")


def repaired_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired conversations: conv_id, position (from 0), edit (K, R or I), role, text."""
    rows = ordered(_keyed(turns, conv_id), conv_id, turn, role, text)
    told = materialize(audited(rows)).select("conv", "audit")
    conv = rows.schema["conv"].dataType.simpleString()
    names = ["conv", "position", "edit", "role", "text"]
    types = [pa.int64() if conv == "bigint" else pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]

    def rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        rewriter = last = None
        position = 0
        number = lambda turns: [dict(zip(names, (last, position + i, *t))) for i, t in enumerate(turns)]
        for b in batches:
            for c, audit, r, t in zip(*(x.to_pylist() for x in b.columns)):
                if audit is not None:
                    if rewriter is not None:
                        yield from number(rewriter.inserts())
                    rewriter, last, position = Rewriter(audit), c, 0
                    continue
                new = number(rewriter.feed(r, t))
                position += len(new)
                yield from new
        if rewriter is not None:
            yield from number(rewriter.inserts())

    out = map_arrow(beside(rows, told), lambda batches: batches_of(rewritten(batches), names, types),
                    f"conv {conv}, position long, edit string, role string, text string")
    return out.withColumnRenamed("conv", conv_id)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of ``conversations`` with damage that depends on the conversation and turn."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = conversations.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("_")).drop("_")


def op11(conversations: DataFrame) -> DataFrame:
    ids = conversations.select(F.col("conv_id").alias("id")).distinct()
    told = repair(damaged(conversations))
    empty = hashlib.sha256(b"").hexdigest()
    return ids.join(told, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in FOUND),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
