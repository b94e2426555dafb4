"""Row keys from a table's PRIMARY KEY: an order-preserving text encoding of one or more columns.

A table keyed by one integer column keeps the published format, the zero-padded number, and that column is read back from
``row_id``. Any other key is encoded column by column, so that keys differ where the columns differ (the texts ``7`` and ``007``
stay apart) and sort as the columns do; its columns are stored as cells too.

  integer   ``1`` and twenty digits; negative: ``0`` and the nines' complement of the digits
  decimal   the same over the text at the column's scale (forty characters)
  text      ``2`` and the text; NUL and \\x01 become \\x01\\x01 and \\x01\\x02, and NUL ends it if columns follow
  NULL      ``!``

Dates and times sort as text. Floating-point keys are kept as text, so they don't sort by value. Texts compare by their bytes,
whatever their collation.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.scalars import seldom, zero_pad

INTEGER = {"tinyint", "smallint", "mediumint", "int", "integer", "bigint", "year"}
INT_WIDTH, DECIMAL_WIDTH = 20, 40


@dataclass(frozen=True)
class Key:
    """Key columns in key order with their kinds: ``int``, ``decimal(p,s)`` or ``text``."""

    columns: tuple[str, ...]
    kinds: tuple[str, ...]

    @property
    def plain(self) -> bool:
        """One integer column: the published zero-padded form, read back from row_id."""
        return self.kinds == ("int",)


def key_kind(mysql_type: str, scale: int | None) -> str:
    if mysql_type in INTEGER:
        return "int"
    return f"decimal(38,{scale or 0})" if mysql_type == "decimal" else "text"


def key_of(schema: list) -> Key | None:
    """Key of (column, mysql_type, scale, key_pos) rows; None if the table declares none (then its first column is the key)."""
    own = sorted((r for r in schema if r["key_pos"]), key=lambda r: r["key_pos"])
    if not own:
        return None
    return Key(tuple(r["column"] for r in own), tuple(key_kind(r["mysql_type"], r["scale"]) for r in own))


def _number(digits: Column, negative: Column, width: int) -> Column:
    padded = F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), "0")
    return F.when(negative, F.concat(F.lit("0"), F.translate(padded, "0123456789", "9876543210"))).otherwise(
        F.concat(F.lit("1"), padded))


def _text(value: Column, last: bool) -> Column:
    v = F.replace(F.replace(value, F.lit("\x01"), F.lit("\x01\x02")), F.lit("\x00"), F.lit("\x01\x01"))
    return F.concat(F.lit("2"), v, F.lit("" if last else "\x00"))


def encoded(value: Column, kind: str, last: bool = True) -> Column:
    """One key column as text; ``last`` columns need no end mark. A value that isn't of its kind is kept as text."""
    if kind == "int":  # a number as Spark writes it, like most keys, needs no decimal arithmetic
        n = value.try_cast("bigint")
        return F.when((n >= 0) & (n.cast("string") == value), F.concat(F.lit("1"), F.lpad(value, INT_WIDTH, "0"))).otherwise(
            seldom(value, lambda v: _encoded(v, kind, last)))
    return _encoded(value, kind, last)


def _encoded(value: Column, kind: str, last: bool) -> Column:
    out = _text(value, last)
    if kind != "text":
        n = value.try_cast("decimal(20,0)" if kind == "int" else kind)
        # an integer literal with a fraction isn't one
        whole = n.isNotNull() & value.rlike(r"^-?[0-9]+$") if kind == "int" else n.isNotNull()
        width = INT_WIDTH if kind == "int" else DECIMAL_WIDTH
        out = F.when(whole, _number(F.abs(n).cast("string"), n < 0, width)).otherwise(out)
    return F.when(value.isNull(), F.lit("!")).otherwise(out)


def row_key(values: list[Column], key: Key) -> tuple[Column, Column]:
    """(row_key, row_id) of the key columns' values; row_id is the leading column where it is an integer."""
    lead = values[0].try_cast("bigint") if key.kinds[0] == "int" else F.lit(None).cast("bigint")
    if key.plain:
        return zero_pad(values[0]), lead
    parts = [encoded(v, k, i + 1 == len(values)) for i, (v, k) in enumerate(zip(values, key.kinds))]
    return F.concat(*parts), lead


PRIMARY_RX = r"(?is)\bPRIMARY\s+KEY\s*(?:USING\s+\w+\s*)?\(((?:[^()]++|\([^()]*+\))*+)\)"


def primary_key(create_payload: Column, quoted_rx: str) -> Column:
    """Names of the PRIMARY KEY's columns in key order (empty without one)."""
    bare = F.regexp_replace(create_payload, quoted_rx, "''")
    return F.regexp_extract_all(F.regexp_extract(bare, PRIMARY_RX, 1), F.lit("`([^`]*)`"), 1)


def is_text_type(sql_type: str) -> bool:
    return bool(re.match(r"string|varchar|char", sql_type, re.I))
