"""INSERT chunks -> rows -> cells.

A chunk row carries one INSERT payload (up to ~16 MB). Tuples and fields are split with native regexes inside the
task that holds the chunk; the column names come from the table's DDL (a short driver-side list) or, for many
tables at once, from a per-table array joined on tbl_name behind a size check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import Key, row_key
from tidemark.functions.scalars import FAMILY, key_hash, zero_pad
from tidemark.functions.tuples import split_fields, split_tuples, token_value

SCHEMA_BROADCAST_ROWS = 100_000  # tables×columns above this are joined by shuffle instead of broadcast


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint only after checking the frame's row count (a cheap action on metadata-sized frames)."""
    return bounded_broadcast_n(df, max_rows)[0]


def bounded_broadcast_n(df: DataFrame, max_rows: int) -> tuple[DataFrame, int]:
    """As ``bounded_broadcast``, also returning the counted rows (capped at max_rows + 1)."""
    n = df.limit(max_rows + 1).count()
    return (F.broadcast(df) if n <= max_rows else df), n


def chunk_rows(chunks: DataFrame, payload: str = "payload", keep: list[str] | None = None) -> DataFrame:
    """(keep…, tuple_pos, fields) — one row per tuple of each chunk, fields as raw tokens."""
    keep = keep if keep is not None else [c for c in chunks.columns if c != payload]
    t = chunks.select(*keep, F.posexplode(split_tuples(payload)).alias("tuple_pos", "tuple_text"))
    return t.select(*keep, "tuple_pos", split_fields("tuple_text").alias("fields"))


def _arity_checked(rows: DataFrame, n: Column) -> DataFrame:
    msg = F.concat(F.lit("Mismatching column/value count: "), F.size("fields").cast("string"), F.lit(" vs "),
                   n.cast("string"))
    # checked where the fields are made: a filter would be moved below that step and split every row again
    return rows.withColumn("fields", F.when(F.size("fields") == n, F.col("fields")).otherwise(F.raise_error(msg).cast("array<string>")))


def rows_to_cells(rows: DataFrame, columns: list[str] | None = None, names: str | None = None,
                  literal_nulls: bool = False, keep: list[str] | None = None, key: Key | None = None) -> DataFrame:
    """(keep…, row_key, row_id, column, value, is_null).

    Either ``columns`` (the table's column list, with its ``key``) or ``names`` (an array column of column names) is given.
    Without a key position 0 is the key (padded row_key, bigint row_id) and no cell; a key of one integer column is no cell
    either; the columns of any other key are cells like the rest. A field/column count mismatch raises."""
    keep = keep if keep is not None else [c for c in rows.columns if c not in ("fields", names)]
    if columns is not None:
        name_arr = F.array(*[F.lit(c) for c in columns])
        n = F.lit(len(columns))
    else:
        name_arr = F.col(names)
        n = F.size(names)
    r = _arity_checked(rows, n)
    r = row_keys(r, columns, key, [*keep, "fields"] + ([] if columns is not None else [names]))
    r = r.select(*keep, "row_key", "row_id",
                 F.arrays_zip(F.col("fields").alias("tok"), name_arr.alias("name")).alias("_zip"))
    if key is None:
        body = F.slice("_zip", 2, F.size("_zip"))
    else:
        body = F.filter("_zip", lambda z: z["name"] != F.lit(key.columns[0])) if key.plain else F.col("_zip")
    # the outer form: for the inner one Spark adds a filter below the split, which then runs once more per condition
    c = r.select(*keep, "row_key", "row_id", F.explode_outer(body).alias("_z")).filter(F.col("_z").isNotNull())
    value, is_null = token_value(F.col("_z.tok"), literal_nulls)
    return c.select(*keep, "row_key", "row_id", F.concat(F.lit(FAMILY + ":"), F.col("_z.name")).alias("column"),
                    value.alias("value"), is_null.alias("is_null"))


def cell_columns(columns: list[str], key: Key | None) -> list[str]:
    """Columns that are cells: all but the key's, where it is one integer column or none is declared."""
    own = columns[0] if key is None else key.columns[0] if key.plain else None
    return [c for c in columns if c != own]


def chunk_packed(chunks: DataFrame, columns: list[str], keep: list[str] | None = None, key: Key | None = None) -> DataFrame:
    """As ``chunk_cells`` with one row per row: (keep…, tuple_pos, row_key, row_id, tokens), the tokens of its cells in one array.
    Steps that take whole rows, such as the last of several puts, then move each key once instead of once per cell."""
    rows = chunk_rows(chunks, keep=keep)
    keep = [c for c in rows.columns if c != "fields"]
    r = row_keys(_arity_checked(rows, F.lit(len(columns))), columns, key, [*keep, "fields"])
    cells = cell_columns(columns, key)
    at = next((i for i, c in enumerate(columns) if c not in cells), None)  # the field that is no cell
    tokens = F.col("fields") if at is None else F.concat(F.slice("fields", 1, at), F.slice("fields", at + 2, max(1, len(columns))))
    packed = r.select(*keep, "row_key", "row_id", tokens.alias("tokens"))
    return packed if cells else packed.filter(F.lit(False))  # a row without cells leaves no trace


def named(packed: DataFrame, names: list[str]) -> DataFrame:
    """Packed rows that carry their cells' columns, for frames in which these differ."""
    return packed.withColumn("names", F.array(*[F.lit(c) for c in names]).cast("array<string>"))


def unpacked(packed: DataFrame, names: list[str] | None = None, literal_nulls: bool = False) -> DataFrame:
    """Cells of packed rows; their columns are ``names``, or else those that each row carries."""
    keep = [c for c in packed.columns if c not in ("tokens", "names")]
    own = F.col("names") if names is None else F.array(*[F.lit(c) for c in names])
    # the outer form, as in rows_to_cells
    c = packed.select(*keep, *([] if names is not None else ["names"]), F.posexplode_outer("tokens").alias("_p", "_t")).filter(F.col("_p").isNotNull())
    value, is_null = token_value("_t", literal_nulls)
    return c.select(*keep, F.concat(F.lit(FAMILY + ":"), F.get(own, F.col("_p"))).alias("column"), value.alias("value"), is_null.alias("is_null"))


def row_keys(rows: DataFrame, columns: list[str] | None, key: Key | None, keep: list[str]) -> DataFrame:
    """(keep…, row_key, row_id) of rows with ``fields``; each key value is parsed once, however often the key's encoding uses it."""
    at = [1] if key is None else [columns.index(c) + 1 for c in key.columns]
    names = [f"_k{i}" for i in range(len(at))]
    r = rows.select(*keep, *[token_value(F.element_at("fields", a))[0].alias(n) for a, n in zip(at, names)])
    k, i = (zero_pad("_k0"), F.col("_k0").try_cast("bigint")) if key is None else row_key([F.col(n) for n in names], key)
    return r.select(*keep, k.alias("row_key"), i.alias("row_id"))


def chunk_cells(chunks: DataFrame, columns: list[str], literal_nulls: bool = False,
                keep: list[str] | None = None, key: Key | None = None) -> DataFrame:
    """F11 + P9 for one table: chunk frame with ``payload`` -> cells."""
    rows = chunk_rows(chunks, keep=keep)
    return rows_to_cells(rows, columns, literal_nulls=literal_nulls, key=key)


def last_rows(packed: DataFrame, group: list[str] | None = None) -> DataFrame:
    """One packed row per (group…, row_key): the last put by seq and tuple_pos."""
    keys = [*(group or []), "row_key"]
    rest = [c for c in packed.columns if c not in (*keys, "seq", "tuple_pos")]
    last = F.max_by(F.struct(*rest), F.struct("seq", "tuple_pos"))
    return packed.withColumn("_h", key_hash(*keys)).groupBy("_h", *keys).agg(last.alias("_l")).select(
        *keys, *[F.col(f"_l.{c}").alias(c) for c in rest])


def last_puts(cells: DataFrame, order: list[str], group: list[str] | None = None) -> DataFrame:
    """One cell per (group…, row_key, column): the last put by ``order`` wins, and ``n_puts`` tells how many there were
    (more than one: rows of a dump share a key)."""
    keys = [*(group or []), "row_key", "column"]
    rest = [c for c in cells.columns if c not in (*keys, *order)]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return cells.groupBy(*keys).agg(last.alias("_l"), F.count(F.lit(1)).alias("n_puts")).select(
        *keys, *[F.col(f"_l.{c}").alias(c) for c in rest], "n_puts")


def chunk_id_range(rows_or_cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A1: (by…, first_id, last_id, n_rows) per chunk. An empty chunk raises."""
    by = by or ["md5"]
    keys = rows_or_cells.select(*by, "row_key", "row_id").distinct()
    g = keys.groupBy(*by).agg(F.min("row_id").alias("first_id"), F.max("row_id").alias("last_id"),
                             F.count(F.lit(1)).alias("n_rows"))
    return g.filter(F.when(F.col("n_rows") > 0, F.lit(True)).otherwise(F.raise_error(F.lit("NO DATA")).cast("boolean")))
