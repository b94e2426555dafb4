"""Version and tombstone semantics of the published store."""

from pyspark.sql import functions as F

from tidemark.operators import history as H

KEY, COL, T0 = "000004711", "mysql:price", 1_700_000_000
PRICES = {10: "12.50", 25: "11.90", 40: "11.90", 70: "9.95", 95: None}  # seconds after T0 -> value (None: SQL NULL)


def _cells(spark, prices):
    rows = [(KEY, 4711, COL, T0 + t, v, v is None) for t, v in prices.items()]
    return spark.createDataFrame(rows, "row_key string, row_id long, column string, ts long, value string, "
                                       "is_null boolean")


def _tomb(spark, t, column=COL):
    return spark.createDataFrame([(KEY, column, T0 + t)], "row_key string, column string, ts long")


def _read(df):
    return [(r["value"], r["ts"] - T0) for r in df.collect()]


def test_one_put_is_read_back(spark):
    assert [r["value"] for r in H.row_get(_cells(spark, {10: "12.50"}), KEY).collect()] == ["12.50"]


def test_versions_and_asof_bounds(spark):
    c = _cells(spark, PRICES)
    assert H.versions(c, 9).count() == 5
    assert [r["ts"] - T0 for r in H.versions(c, 2).orderBy("version").collect()] == [95, 70]
    assert H.asof(c, T0 + 9).count() == 0  # before the first version
    assert _read(H.asof(c, T0 + 25)) == [("11.90", 25)]  # bounds are inclusive
    assert _read(H.asof(c, T0 + 69)) == [("11.90", 40)]
    assert _read(H.asof(c, T0 + 1000)) == [(None, 95)]  # the last value with its own time, a NULL here


def test_tombstone_literal_hides_for_every_read(spark):
    c, t = _cells(spark, PRICES), _tomb(spark, 40)
    assert sorted(r["ts"] - T0 for r in H.mask_tombstones(c, t, mode="literal").collect()) == [70, 95]
    for at in (10, 39, 40, 69):
        assert H.masked_asof(c, t, T0 + at, "literal").count() == 0
    assert _read(H.masked_asof(c, t, T0 + 80, "literal")) == [("9.95", 70)]


def test_tombstone_corrected_keeps_the_past(spark):
    c, t = _cells(spark, PRICES), _tomb(spark, 40)
    assert _read(H.masked_asof(c, t, T0 + 39, "corrected")) == [("11.90", 25)]
    assert H.masked_asof(c, t, T0 + 40, "corrected").count() == 0
    assert H.masked_asof(c, t, T0 + 69, "corrected").count() == 0
    assert _read(H.masked_asof(c, t, T0 + 70, "corrected")) == [("9.95", 70)]


def test_row_tombstone_hides_all_columns(spark):
    c, t = _cells(spark, PRICES), _tomb(spark, 70, None)
    assert _read(H.masked_asof(c, t, None, "literal")) == [(None, 95)]


def test_cap_versions(spark):
    assert sorted(r["ts"] - T0 for r in H.cap_versions(_cells(spark, PRICES), 3).collect()) == [40, 70, 95]


def test_cap_versions_query_keeps_the_stores_limit(spark, tmpdir_run):
    from tidemark.queries import Q
    spark.range(1005).select(
        F.col("id").alias("event_id"), F.lit(7).cast("bigint").alias("user_id"), F.lit("view").alias("event_type"),
        F.timestamp_micros(F.col("id") * 1000000).cast("timestamp_ntz").alias("ts"), F.col("id").cast("double").alias("value"),
    ).write.parquet(f"{tmpdir_run}/events.parquet")
    assert sorted(int(r["value"]) for r in Q["cap_versions"](spark, tmpdir_run).collect()) == [i * 100 for i in range(6, 1005)]
