"""Catalogue listings and table selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import epoch_iso
from tidemark.operators.positions import positions

PAGE = 1000  # hashes of one page of a table's list


def list_tables(ddl: DataFrame, dump_ts: int | None = None) -> DataFrame:
    """(namespace, dump_ts, name) of CREATE statements, sorted."""
    d = ddl if dump_ts is None else ddl.filter(F.col("dump_ts") == dump_ts)
    return d.select("namespace", "dump_ts", "name").distinct().orderBy("namespace", "dump_ts", "name")


def list_views(views: DataFrame, dump_ts: int | None = None) -> DataFrame:
    """(namespace, dump_ts, name) of views, sorted."""
    return list_tables(views, dump_ts)


def list_dumps(dumps: DataFrame) -> DataFrame:
    """(namespace, dump_ts, iso) sorted; ``dumps`` has namespace, dump_ts (e.g. stage_meta or manifest)."""
    return dumps.select("namespace", "dump_ts").distinct().withColumn("iso", epoch_iso("dump_ts")).orderBy(
        "namespace", "dump_ts")


def list_namespaces(*frames: DataFrame) -> DataFrame:
    """Distinct namespaces (a column, so names containing '_' stay whole)."""
    out = frames[0].select("namespace")
    for f in frames[1:]:
        out = out.unionByName(f.select("namespace"))
    return out.distinct().orderBy("namespace")


def select_tables(tables: DataFrame, include: DataFrame | None = None, exclude: DataFrame | None = None) -> DataFrame:
    """Include list wins (semi join); otherwise everything not excluded (anti join).
    ``tables`` has tbl_name; lists have tbl_name (see sources.dumpfile.read_list)."""
    if include is not None and not include.isEmpty():
        return tables.join(include.select("tbl_name").distinct(), "tbl_name", "left_semi")
    if exclude is not None:
        return tables.join(exclude.select("tbl_name").distinct(), "tbl_name", "left_anti")
    return tables


def has_data(manifest: DataFrame, tables: DataFrame) -> DataFrame:
    """P12 per table: whether any chunk exists (semi join; no payload is read)."""
    present = manifest.select("tbl_name").distinct().withColumn("has_data", F.lit(True))
    return tables.select("tbl_name").distinct().join(present, "tbl_name", "left").select(
        "tbl_name", F.coalesce("has_data", F.lit(False)).alias("has_data"))


def hash_pages(manifest: DataFrame, size: int = PAGE) -> DataFrame:
    """A4: (namespace, dump_ts, tbl_name, page, hashes): the ordered hash list of each table of a dump, in pages of ``size``
    hashes, so that no list grows with the table."""
    p = positions(manifest, ["namespace", "dump_ts", "tbl_name"], "seq", "_at").withColumn("page", F.floor(F.col("_at") / size).cast("bigint"))
    return p.groupBy("namespace", "dump_ts", "tbl_name", "page").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_at", "md5"))), lambda x: x["md5"]).alias("hashes"))


def manifest_wide(ddl: DataFrame, views: DataFrame, manifest: DataFrame, meta: DataFrame) -> DataFrame:
    """U4: the per-dump manifest as one long (namespace, dump_ts, family, key, value) frame — the union of the
    tables/views/hashes/meta families. ``map_from_entries`` over it gives the wide map per dump. Hash lists are paged (see
    ``hash_pages``): the key of a page is ``table:page`` and its value the hashes, comma-joined."""
    t = ddl.select("namespace", "dump_ts", F.lit("tables").alias("family"), F.col("name").alias("key"),
                   F.col("stmt").alias("value"))
    v = views.select("namespace", "dump_ts", F.lit("views").alias("family"), F.col("name").alias("key"),
                     F.col("stmt").alias("value"))
    h = hash_pages(manifest).select(
        "namespace", "dump_ts", F.lit("hashes").alias("family"), F.concat_ws(":", "tbl_name", F.col("page").cast("string")).alias("key"),
        F.array_join("hashes", ",").alias("value"))
    m = meta.select("namespace", "dump_ts", F.lit("meta").alias("family"),
                    F.explode(F.create_map(F.lit("status"), F.col("status"), F.lit("rowcount"),
                                           F.col("rowcount").cast("string"), F.lit("md5"), F.col("md5")))
                    .alias("key", "value"))
    return t.unionByName(v).unionByName(h).unionByName(m)
