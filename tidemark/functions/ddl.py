"""DDL column extraction (F14), type mapping (F15, P10), qualified names (P11) and typed reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import primary_key
from tidemark.functions.scalars import FAMILY

# MySQL base type -> type name of the published SQL table (19 entries, as published).
MYSQL_TO_SQL = {
    "tinyint": "tinyint",
    "smallint": "smallint",
    "int": "int",
    "mediumint": "int",
    "bigint": "bigint",
    "float": "float",
    "double": "double",
    "set": "string",
    "tinytext": "string",
    "varchar": "string",
    "mediumtext": "string",
    "text": "string",
    "enum": "string",
    "time": "string",
    "date": "string",
    "datetime": "string",
    "timestamp": "string",
    "decimal": "string",
    "longblob": "binary",
}
UNKNOWN_SQL_TYPE = "string"  # any other MySQL type is published as string and flagged mapped=false

# native_types=True: richer Spark types where the text form is unambiguous.
NATIVE_OVERRIDES = {"date": "date", "datetime": "timestamp", "timestamp": "timestamp"}
UNSIGNED_WIDEN = {"tinyint": "smallint", "smallint": "int", "int": "bigint", "mediumint": "bigint",
                  "bigint": "decimal(20,0)"}

QUOTED_RX = r"(?s)'(?:[^'\\]++|\\.|'')*+'"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def column_pieces(create_payload) -> Column:
    """Array of column-definition texts of a CREATE payload ``(`a` int(10), …, KEY …) ENGINE=…``.

    Quoted strings (enum values, comments) are blanked, then one walk over the characters with a running depth keeps
    what stands outside inner parentheses, up to the parenthesis that closes the list, so ``enum('a,b')``,
    ``double(18,2)``, composite keys and generated expressions of any depth do not produce or hide columns."""
    s = F.regexp_replace(_c(create_payload), QUOTED_RX, "''")
    s = F.regexp_replace(s, r"^\s*\(", "")
    # texts between parentheses, each with the parenthesis before it: few pieces even in a long CREATE
    parts = F.regexp_extract_all(s, F.lit(r"(?s)[()]?[^()]*+"), 0)
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("out"))

    def step(a, part):
        first = F.substring(part, 1, 1)
        depth = F.when(a["depth"] < 0, a["depth"]).when(first == "(", a["depth"] + 1).when(first == ")", a["depth"] - 1) \
            .otherwise(a["depth"])
        text = F.when(first.isin("(", ")"), F.substring(part, F.lit(2), F.length(part))).otherwise(part)
        return F.struct(depth.alias("depth"), F.when(depth == 0, F.concat(a["out"], F.array(text))).otherwise(a["out"]).alias("out"))

    s = F.aggregate(parts, start, step, lambda a: F.array_join(a["out"], ""))
    return F.filter(F.transform(F.split(s, ","), lambda x: F.trim(x, F.lit(" \t\r\n"))), lambda x: x.startswith("`"))


def parse_ddl(df: DataFrame, payload: str = "payload", keep: list[str] | None = None) -> DataFrame:
    """one row per column: keep…, pos, column, mysql_type, unsigned, precision, scale, key_pos (place in the
    PRIMARY KEY from 1; 0 outside it)."""
    keep = keep if keep is not None else [c for c in df.columns if c != payload]
    ex = df.select(*keep, payload, primary_key(_c(payload), QUOTED_RX).alias("_key"),
                   F.posexplode(column_pieces(payload)).alias("pos", "piece"))
    name = F.regexp_extract("piece", r"^`([^`]+)`", 1)
    mtype = F.lower(F.regexp_extract("piece", r"^`[^`]+`\s+([A-Za-z]+)", 1))
    # precision/scale come from the original text (they were removed with the parentheses)
    args_rx = F.concat(F.lit(r"`\Q"), name, F.lit(r"\E`\s+[A-Za-z]+\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)"))
    return ex.select(
        *keep,
        "pos",
        name.alias("column"),
        mtype.alias("mysql_type"),
        F.lower(F.col("piece")).rlike(r"\bunsigned\b").alias("unsigned"),
        F.call_function("regexp_extract", F.col(payload), args_rx, F.lit(1)).try_cast("int").alias("precision"),
        F.call_function("regexp_extract", F.col(payload), args_rx, F.lit(2)).try_cast("int").alias("scale"),
        F.array_position("_key", name).cast("int").alias("key_pos"),
    )


def type_map_expr(mysql_type, unsigned=None, precision=None, scale=None, native: bool = False) -> Column:
    """SQL type name for a MySQL base type column."""
    t = _c(mysql_type)
    m = F.create_map(*[x for k, v in MYSQL_TO_SQL.items() for x in (F.lit(k), F.lit(v))])
    out = F.coalesce(F.element_at(m, t), F.lit(UNKNOWN_SQL_TYPE))
    if native:
        dec = F.concat(F.lit("decimal("), F.coalesce(_c(precision), F.lit(10)).cast("string"), F.lit(","),
                       F.coalesce(_c(scale), F.lit(0)).cast("string"), F.lit(")"))
        out = F.when(t == "decimal", dec).otherwise(out)
        for k, v in NATIVE_OVERRIDES.items():
            out = F.when(t == k, F.lit(v)).otherwise(out)
        if unsigned is not None:
            for k, v in UNSIGNED_WIDEN.items():
                out = F.when(_c(unsigned) & (t == k), F.lit(v)).otherwise(out)
    return out


def with_types(schema_df: DataFrame, native: bool = False) -> DataFrame:
    """Adds sql_type, mapped and qualified (family:column) to a parse_ddl frame."""
    keys = F.array(*[F.lit(k) for k in MYSQL_TO_SQL])
    return schema_df.withColumn(
        "sql_type", type_map_expr("mysql_type", "unsigned", "precision", "scale", native)
    ).withColumn("mapped", F.array_contains(keys, F.col("mysql_type"))).withColumn(
        "qualified", F.concat(F.lit(FAMILY + ":"), F.col("column"))
    )


def typed_read(value, sql_type: str) -> Column:
    """typed view of a string cell. ANSI mode is on in Spark 4, so a plain cast of 'NULL' would throw."""
    v = _c(value)
    if sql_type == "string":
        return v
    if sql_type == "binary":
        return v.cast("binary")  # the bytes as they are
    return v.try_cast(sql_type)


def struct_type(columns: list[tuple[str, str]]) -> T.StructType:
    """StructType of (column, sql_type) pairs, e.g. for an empty schema-only table."""
    return T.StructType([T.StructField(c, T._parse_datatype_string(t), True) for c, t in columns])
