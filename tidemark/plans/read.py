"""Reading published tables: typed as-of projection (L6, K7, K11, F17) and staged views."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.ddl import struct_type, typed_read
from tidemark.functions.keys import Key, is_text_type
from tidemark.functions.scalars import FAMILY
from tidemark.operators import history as H


# A string literal (left alone), or FROM / JOIN, a quoted name that is no qualifier, and its alias.
REFERENCE = re.compile(r"'(?:[^'\\]|\\.|'')*'|(\b(?:from|join)\b[\s(]*)`([^`]+)`(?!\s*\.)(\s+(?:as\s+)?`[^`]+`)?", re.I | re.S)


def _key(column: tuple[str, str], key_type: str | None) -> Column:
    """The key column of a table without a PRIMARY KEY under its DDL name: a string key from row_key, others from row_id."""
    name, sql_type = column
    kind = key_type or ("string" if is_text_type(sql_type) else "bigint")
    key = F.col("row_id").cast(kind)
    return (F.coalesce(key, F.col("row_key")) if kind == "string" else key).alias(name)


def typed_asof(cells: DataFrame, columns: list[tuple[str, str]], ts=None, tombstones: DataFrame | None = None,
               key_type: str | None = None, key: Key | None = None) -> DataFrame:
    """Typed table as of ``ts`` straight from the history (as-of, tombstones and pivot in one aggregation).

    A key of one integer column is read back from ``row_id`` (published as a bigint); the columns of any other PRIMARY KEY
    are cells and have their DDL types. Without a key the first column is the key."""
    own = columns[0][0] if key is None else key.columns[0] if key.plain else None
    wide = H.asof_wide(cells, [f"{FAMILY}:{c}" for c, _ in columns if c != own], ts, tombstones=tombstones)
    return wide.select(*[_key((c, t if key is None else "bigint"), key_type) if c == own else typed_read(F.col(f"`{c}`"), t).alias(c)
                         for c, t in columns])


def schema_only(spark: SparkSession, columns: list[tuple[str, str]]) -> DataFrame:
    """The empty typed table (schema publish only)."""
    return spark.createDataFrame([], struct_type([(columns[0][0], "bigint")] + columns[1:]))


def register(df: DataFrame, namespace: str, tbl: str) -> str:
    """K7: expose as temp view ``namespace_tbl``; returns the name."""
    name = f"{namespace}_{tbl}"
    df.createOrReplaceTempView(name)
    return name


def apply_views(spark: SparkSession, views: list[tuple[str, str]], namespace: str,
                tables: list[str]) -> list[tuple[str, str, str | None]]:
    """Create each staged view as ``namespace_view`` over the published ``namespace_table`` views.

    References after FROM and JOIN are rewritten to the published names and keep the old name as alias, so columns
    qualified by the table resolve. A view over other views is created after them. Failures are collected, not raised.
    Returns (view, status, error) in the given order."""
    known = {*tables, *(n for n, _ in views)}

    def published(m: re.Match) -> str:
        if m[2] not in known:
            return m[0]
        return f"{m[1]}`{namespace}_{m[2]}`{m[3] or f' AS `{m[2]}`'}"

    over = {n: {m[2] for m in REFERENCE.finditer(body)} - {n} for n, body in views}
    for n, _ in views:  # a view left by an earlier call must not stand in for one that is not created yet
        spark.catalog.dropTempView(f"{namespace}_{n}")
    done: dict[str, tuple[str, str | None]] = {}
    todo = list(views)
    while todo:
        waiting = {n for n, _ in todo}
        ready = [v for v in todo if not over[v[0]] & waiting]
        if not ready:
            done.update({n: ("failed", "views refer to each other") for n in waiting})
            break
        for name, body in ready:
            try:
                spark.sql(REFERENCE.sub(published, body)).createOrReplaceTempView(f"{namespace}_{name}")
                done[name] = ("created", None)
            except Exception as e:  # keep going: one broken view must not stop the others
                done[name] = ("failed", str(e))
        todo = [v for v in todo if v not in ready]
    return [(n, *done[n]) for n, _ in views]
