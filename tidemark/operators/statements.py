"""Dump text -> statements.

Input: lines ``(dump_id, line_no, value)`` with dense 0-based line numbers (see ``sources.dumpfile``). INSERT lines
may be ~16 MB each: every per-line expression looks only at a bounded prefix or uses anchored patterns, and the
CREATE assembly works on non-INSERT text plus INSERT markers only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import dump_time_epoch, forced_date_epoch, line_md5
from tidemark.operators.positions import segment_start

PREFIX = 512  # characters in which a table name is looked for first; beyond them the whole line is searched
NAME_RX = r"^\s*+\S++\s++\S++\s++(`[^`]*+`|[^\s(`]++)"
VIEW_RX = r"^/\*!50001 VIEW\s++(`[^`]*+`|[^`\s]++)\s++AS\s"
FINGERPRINT_BUCKET = 1 << 16  # lines per first-level digest
VIEW_MARK = "/*!50001 VIEW"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _strip(x: Column) -> Column:
    """Python-style strip of surrounding whitespace (Spark's trim only removes spaces)."""
    return F.regexp_replace(x, r"^\s++|(?<!\s)\s++$", "")  # a run of blanks is tried once, at its start


def action(value) -> Column:
    """First six characters, stripped — the statement verb."""
    return _strip(F.substring(_c(value), 1, 6))


def kind(value) -> Column:
    """View | insert | create | useless | other (VIEW is tested first; INSERT/CREATE are exact, column 0)."""
    v = _c(value)
    a = action(v)
    return (F.when(F.substring(v, 1, 13) == VIEW_MARK, F.lit("view"))
            .when(a == "INSERT", F.lit("insert"))
            .when(a == "CREATE", F.lit("create"))
            .when(F.substring(a, 1, 2).isin("--", "/*") | (a == ""), F.lit("useless"))
            .otherwise(F.lit("other")))


def classify(lines: DataFrame) -> DataFrame:
    return lines.withColumn("kind", kind("value"))


def statement_table(value, k) -> Column:
    """Table name = third token before the first '(' (views: the name before AS), without its backticks.

    The anchored possessive patterns stop at the name; a line whose first characters do not hold it is searched whole."""
    v = _c(value)
    head = F.substring(v, 1, PREFIX)

    def first(rx: str, end: str) -> Column:
        near = F.regexp_extract(head, rx + end, 1)
        found = F.when(near != "", near).otherwise(F.regexp_extract(v, rx, 1))
        return F.regexp_replace(found, "^`|`$", "")

    name, view = first(NAME_RX, r"(?=[\s(])"), first(VIEW_RX, "")
    return F.when(_c(k) == "view", view).when(_c(k).isin("insert", "create"), name).otherwise(F.lit(""))


def _rstripped(value) -> Column:
    """Without blanks at the end; no regular expression, which would lose the bytes of text that is not valid UTF-8."""
    return F.rtrim(_c(value), F.lit(" \t\n\x0b\x0c\r"))


def insert_payload(value) -> Column:
    """Tuple list of an INSERT: from the first '(' up to the final ';' (exclusive)."""
    s = _rstripped(value)
    start = F.instr(s, "(")
    end = F.when(s.endswith(";"), F.length(s) - 1).otherwise(F.length(s))
    return F.when(start > 0, F.substring(s, start, end - start + 1)).otherwise(F.lit(""))


def statement_text(value) -> Column:
    """Statement up to its last ';' inclusive."""
    s = _strip(_c(value))
    tail = F.substring_index(s, ";", -1)
    return F.when(F.instr(s, ";") > 0, F.substring(s, 1, F.length(s) - F.length(tail))).otherwise(s)


def create_payload(stmt) -> Column:
    """P5: from the first '(' to the last ';', trailing ' */;' characters dropped."""
    s = statement_text(stmt)
    x = F.substring(s, F.instr(s, "("), F.length(s))
    return F.regexp_replace(x, r"[ */;]+$", "")


def view_body(value) -> Column:
    """SELECT text of a '/*!50001 VIEW `v` AS … */;' line (regex, so names containing AS are safe)."""
    return F.regexp_replace(
        F.regexp_extract(statement_text(value), r"(?s)^/\*!50001 VIEW\s+`?[^`\s]+`?\s+AS\s+(.*)$", 1),
        r"[ */;]+$", "")


def skip_filter(tbl: Column, skip_tables: list[str] | None) -> Column:
    """Keep statements whose table is not in the skip list (applies to CREATE and INSERT, not to VIEW)."""
    if not skip_tables:
        return F.lit(True)
    return ~tbl.isin(list(skip_tables))


def create_statements(classified: DataFrame, mode: str = "corrected") -> DataFrame:
    """W4 + A10: (dump_id, line_no, tbl_name, stmt) — each CREATE line plus the following 'other' lines.

    Gaps and islands: every non-'other' line starts a segment; a segment starting with CREATE is one statement.
    INSERT bodies are dropped first (markers stay), so the shuffle carries DDL-sized text only. corrected: any
    boundary or the end of the dump closes a CREATE; literal: only a following 'useless' line does."""
    small = classified.select(
        "dump_id", "line_no", "kind",
        F.when(F.col("kind") == "insert", F.lit(None).cast("string")).otherwise(F.col("value")).alias("value"))
    seg = segment_start(small.withColumn("_start", F.col("kind") != "other"), ["dump_id"], "line_no", "_start",
                        out="segment")
    # keep only segments that start with a CREATE before collecting: a long run of 'other' lines after some other
    # boundary (e.g. REPLACE INTO statements) must never be gathered into one group
    starts = small.filter(F.col("kind") == "create").select("dump_id", F.col("line_no").alias("segment"))
    g = seg.join(starts, ["dump_id", "segment"], "left_semi").groupBy("dump_id", "segment").agg(
        F.max("line_no").alias("last_line"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", _strip(F.col("value")).alias("s")))),
                                 lambda x: x["s"]), "").alias("stmt"),
    )
    if mode == "literal":
        nxt = small.select("dump_id", (F.col("line_no") - 1).alias("last_line"), F.col("kind").alias("next_kind"))
        g = g.join(nxt, ["dump_id", "last_line"]).filter(F.col("next_kind") == "useless")
    return g.select("dump_id", F.col("segment").alias("line_no"),
                    statement_table("stmt", F.lit("create")).alias("tbl_name"), "stmt")


def dump_timestamp(lines: DataFrame, forced: dict | None = None) -> DataFrame:
    """W6 + F8/F9: (dump_id, last_line, dump_ts) from the last line, unless a forced date is given (Q19)."""
    last = lines.groupBy("dump_id").agg(F.max_by("value", "line_no").alias("last_line"))
    parsed = dump_time_epoch("last_line")
    if forced:
        m = F.create_map(*[x for k, v in forced.items() for x in (F.lit(k), F.lit(v))])
        parsed = F.coalesce(forced_date_epoch(F.element_at(m, F.col("dump_id"))), parsed)
    msg = F.concat(F.lit("no dump timestamp for dump "), F.col("dump_id").cast("string"))
    return last.select("dump_id", "last_line",
                       F.coalesce(parsed, F.raise_error(msg).cast("bigint")).alias("dump_ts"))


def row_counts(lines: DataFrame) -> DataFrame:
    """A2: lines per dump."""
    return lines.groupBy("dump_id").agg(F.count(F.lit(1)).alias("rowcount"))


def fingerprint(lines: DataFrame, bucket: int = FINGERPRINT_BUCKET, md5_col: str | None = None) -> DataFrame:
    """A3: order-sensitive digest of a dump: md5 over per-bucket md5s of the line md5s, in line order.

    Two levels keep every collected list bounded (≤ ``bucket`` md5s per group, one digest per bucket per dump).
    It differs from the md5 of the raw bytes by design; for single files under 2 GB use ``file_md5``.
    ``md5_col``: use precomputed line md5s (no text needed)."""
    h = F.col(md5_col) if md5_col else line_md5("value")
    b = lines.select("dump_id", F.floor(F.col("line_no") / bucket).cast("bigint").alias("b"), "line_no", h.alias("h"))
    lvl1 = b.groupBy("dump_id", "b").agg(
        F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "h"))), lambda x: x["h"]),
                           "")).alias("h"))
    return lvl1.groupBy("dump_id").agg(
        F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "h"))), lambda x: x["h"]), ""))
        .alias("line_md5"))
