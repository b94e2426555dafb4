"""Tuple-list parsing (F11) and MySQL literal values (F12), natively in the JVM and exact to the byte.

An INSERT payload is ``(v,v,...),(v,...)``; values are numbers, NULL, single-quoted strings with backslash escapes, strings
with a charset introducer (``_binary '..'``), and hexadecimal and bit literals (``0x..``, ``x'..'``, ``b'..'``). Outside quotes
there is no nesting, so regular expressions suffice. Only possessive quantifiers are used: Java's backtracking recursion on an
ordinary ``(a|b)*`` group overflows the stack on long escaped strings.

A dump line may hold any bytes (a blob is written as it is), and a regular expression over text that is not valid UTF-8
would lose them. So a payload is parsed in its *byte view*, a string with one character per byte (ISO-8859-1), and values
go back to bytes at the end. Text of any charset comes out with the bytes it has in the dump.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import seldom

# Fixed patterns (Java regex syntax).
TUPLE_RX = r"(?s)\((?:[^'()]++|'(?:[^'\\]++|\\.|'')*+')*+\)"
FIELD_RX = r"(?s)\s*+(?:_[A-Za-z0-9]++\s*+|[xXbBnN])?+'(?:[^'\\]++|\\.|'')*+'\s*+|[^,()']++"
NULL_TOKEN = "NULL"
VIEW = "ISO-8859-1"
# MySQL escape sequences that stand for a control character; any other backslash just keeps the next character.
ESCAPES = [("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ("\\0", "\u0000"), ("\\Z", "\u001a"), ("\\b", "\u0008")]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def byte_view(text) -> Column:
    """A string with one character per byte of ``text``."""
    return F.decode(_c(text).cast("binary"), VIEW)


def from_view(view) -> Column:
    """The string (of any bytes) whose byte view this is."""
    return F.encode(_c(view), VIEW).cast("string")


def split_tuples(payload) -> Column:
    """Array of tuple texts ``(…)`` in order, in the byte view."""
    return F.regexp_extract_all(byte_view(payload), F.lit(TUPLE_RX), 0)


def split_fields(tuple_text) -> Column:
    """Array of raw field tokens of one tuple text (outer parentheses included or not)."""
    t = _c(tuple_text)
    inner = F.when(t.startswith("(") & t.endswith(")"), F.substring(t, F.lit(2), F.length(t) - 2)).otherwise(
        F.regexp_replace(F.regexp_replace(t, r"^\s*\(", ""), r"\)\s*$", ""))
    return F.transform(F.regexp_extract_all(inner, F.lit(FIELD_RX), 0), lambda x: F.trim(x))


def unescape_part(p: Column) -> Column:
    p = F.replace(p, F.lit("''"), F.lit("'"))
    for src, dst in ESCAPES:
        p = F.replace(p, F.lit(src), F.lit(dst))
    return F.regexp_replace(p, r"(?s)\\(.)", "$1")


def unescape(token) -> Column:
    """value of a quoted MySQL literal; unquoted tokens are returned as their text.

    Split on escaped backslashes first, so that ``\\\\n`` stays a backslash followed by ``n``."""
    t = _c(token)
    inner = F.substring(t, F.lit(2), F.length(t) - 2)
    parts = F.split(inner, r"\\\\", -1)
    plain = ~inner.contains("\\") & ~inner.contains("''")  # nothing to unescape, as in most values
    return F.when(~t.startswith("'"), t).when(plain, inner).otherwise(F.array_join(F.transform(parts, unescape_part), "\\"))


def _bits_hex(bits: Column) -> Column:
    """Hexadecimal digits of a string of bits, padded to whole bytes on the left."""
    n = F.ceil(F.length(bits) / 8).cast("int")
    padded = F.lpad(bits, n * 8, "0")
    byte = lambda i: F.lpad(F.conv(F.substring(padded, i * 8 + 1, F.lit(8)), 2, 16), 2, "0")
    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), byte), "")).otherwise("")


def literal_view(token) -> Column:
    """Byte view of the value of one field token (not NULL)."""
    t = _c(token)
    inner = F.substring(t, F.lit(2), F.length(t) - 2)
    quote = t.startswith("'")
    return (F.when(quote & ~inner.contains("\\") & ~inner.contains("''"), inner)
            .when(~quote & ~t.endswith("'") & ~t.startswith("0x") & ~t.startswith("0X"), t)
            .otherwise(seldom(t, _literal_view)))


def _literal_view(t: Column) -> Column:
    quoted = F.substring(t, F.instr(t, "'"), F.length(t))  # without an introducer
    body = F.substring(quoted, F.lit(2), F.length(quoted) - 2)
    of_hex = lambda h: F.decode(F.unhex(h), VIEW)
    first = F.substring(t, 1, 1)
    return (F.when(first == "'", unescape(t))
            .when((first == "0") & t.rlike("^0[xX][0-9A-Fa-f]+$"), of_hex(F.substring(t, F.lit(3), F.length(t))))
            .when(~t.endswith("'"), t)
            .when(first.isin("x", "X"), of_hex(body))
            .when(first.isin("b", "B"), of_hex(_bits_hex(body)))
            .otherwise(unescape(quoted)))


def token_value(token, literal_nulls: bool = False) -> tuple[Column, Column]:
    """(value, is_null) of one field token. Corrected mode keeps SQL NULL as a real null flagged ``is_null``;
    ``literal_nulls`` reproduces the 4-character string 'NULL'."""
    t = _c(token)
    is_null = t == F.lit(NULL_TOKEN)
    value = from_view(literal_view(t))
    if literal_nulls:
        return value, F.lit(False)
    return F.when(is_null, F.lit(None).cast("string")).otherwise(value), is_null


def explode_payload(df: DataFrame, payload: str = "payload", literal_nulls: bool = False,
                    keep: list[str] | None = None) -> DataFrame:
    """One row per field: ``keep`` columns + tuple_pos, pos, token, value, is_null, arity.

    Chunks are exploded in their own tasks (one 16 MB payload per row); no shuffle."""
    keep = keep or [c for c in df.columns if c != payload]
    tuples = df.select(*keep, F.posexplode(split_tuples(payload)).alias("tuple_pos", "tuple_text"))
    fields = tuples.select(*keep, "tuple_pos", split_fields("tuple_text").alias("fields"))
    cells = fields.select(
        *keep, "tuple_pos", F.size("fields").alias("arity"), F.posexplode("fields").alias("pos", "token")
    )
    value, is_null = token_value("token", literal_nulls)
    return cells.withColumn("value", value).withColumn("is_null", is_null)
