"""Keys from the PRIMARY KEY (encoding, order, ties) and byte-exact literals."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.ddl import parse_ddl, typed_read
from tidemark.functions.keys import Key, key_of, row_key
from tidemark.functions.tuples import explode_payload
from tidemark.operators.cells import chunk_cells, last_puts
from tidemark.operators.history import asof
from tidemark.plans.read import typed_asof


def _encoded(spark, rows, key):
    schema = ", ".join(f"c{i} string" for i in range(len(key.columns)))
    df = spark.createDataFrame(list(enumerate(rows)), f"i int, v struct<{schema}>")
    k, r = row_key([F.col(f"v.c{i}") for i in range(len(key.columns))], key)
    return {x["i"]: (x["k"], x["r"]) for x in df.select("i", k.alias("k"), r.alias("r")).collect()}


@pytest.mark.parametrize("kinds,draw", [
    (("int", "int"), lambda r: (r.choice([0, 1, -1, 9, 10, -10, 2**63, 18446744073709551615, -(2**63), r.randrange(-500, 500)]),
                                r.randrange(-20, 20))),
    (("text", "int"), lambda r: ("".join(r.choice("ab\x00\x01\x02 7é") for _ in range(r.randrange(4))), r.randrange(3))),
    (("int", "text"), lambda r: (r.randrange(3), r.choice(["7", "007", "07", "", "a", "ab", "a\x00", "a\x01"]))),
    (("decimal(38,2)", "text"), lambda r: (r.randrange(-100000, 100000) / 100, r.choice("xy"))),
])
def test_encoding_is_injective_and_keeps_the_order(spark, kinds, draw):
    rnd = random.Random(3)
    values = sorted({draw(rnd) for _ in range(150)}, key=lambda v: tuple(x.encode() if isinstance(x, str) else x for x in v))
    text = lambda x, k: f"{x:.2f}" if k.startswith("decimal") else str(x)
    got = _encoded(spark, [tuple(text(x, k) for x, k in zip(v, kinds)) for v in values], Key(("a", "b"), kinds))
    keys = [got[i][0].encode() for i in range(len(values))]
    assert keys == sorted(set(keys))


def test_plain_and_single_text_keys(spark):
    assert _encoded(spark, [("7",), ("1234567890123",), ("-5",)], Key(("id",), ("int",))) == {
        0: ("000000007", 7), 1: ("1234567890123", 1234567890123), 2: ("-5", -5)}
    got = _encoded(spark, [("7",), ("007",), ("",), (None,), ("A",)], Key(("c",), ("text",)))
    assert [got[i][0] for i in range(5)] == ["27", "2007", "2", "!", "2A"] and got[0][1] is None


def test_primary_key_of_ddl(spark):
    ddl = [("(`b` varchar(5) COMMENT 'PRIMARY KEY (`x`)', `a` int(11), `d` decimal(9,3),PRIMARY KEY USING BTREE (`d`,`b`(3)),KEY `k` (`a`)) ENGINE=x",),
           ("(`a` int, KEY `PRIMARY KEY` (`a`))",)]
    out = [key_of(parse_ddl(spark.createDataFrame([d], "payload string")).collect()) for d in ddl]
    assert out == [Key(("d", "b"), ("decimal(38,3)", "text")), None]


def test_many_columns_keep_their_names(spark):
    cols = ", ".join(f" `c{i}` decimal({i % 30 + 1},0) DEFAULT (1 + (2 * {i}))" for i in range(900))
    rows = parse_ddl(spark.createDataFrame([(f"({cols}, PRIMARY KEY (`c3`)) ENGINE=x",)], "payload string")).orderBy("pos").collect()
    assert [r["column"] for r in rows] == [f"c{i}" for i in range(900)]


def test_last_put_wins_and_ties_are_told(spark):
    df = spark.createDataFrame([("m", 2, "('a',1,'x'),('a',2,'y'),('a',1,'z')"), ("n", 1, "('a',1,'old')")], "md5 string, seq int, payload string")
    key = Key(("n", "k"), ("int", "text"))
    cells = last_puts(chunk_cells(df, ["k", "n", "v"], keep=["md5", "seq"], key=key), ["seq", "tuple_pos"])
    got = {(r.row_key, r.column): (r.value, r.n_puts) for r in cells.collect()}
    one, two = f"1{1:020d}2a", f"1{2:020d}2a"
    assert got[one, "mysql:v"] == ("z", 3) and got[two, "mysql:v"] == ("y", 1) and got[two, "mysql:k"] == ("a", 1)
    t = typed_asof(cells.withColumn("ts", F.lit(5).cast("long")), [("k", "string"), ("n", "int"), ("v", "string")], key=key)
    assert sorted(t.collect()) == [("a", 1, "z"), ("a", 2, "y")]


def test_equal_versions_are_not_picked_by_chance(spark):
    rows = [("k", 1, "mysql:a", 5, v, False) for v in ("b", "c", "a")]
    h = spark.createDataFrame(rows, "row_key string, row_id long, column string, ts long, value string, is_null boolean").repartition(3)
    assert [r.value for r in asof(h).collect()] == ["c"]


def test_literals_of_every_notation(spark):
    payload = "(1,_binary 'x\\'y',b'101',x'4142',0xFFfe80,N'é', _utf8mb4 'z' ,NULL,'NULL',B'',-1.5e3,X'','0x41',b'1111111100000001','a''b')"
    rows = explode_payload(spark.createDataFrame([(payload,)], "payload string")).orderBy("pos").select(
        F.col("value").cast("binary").alias("v"), "is_null").collect()
    want = [b"1", b"x'y", b"\x05", b"AB", b"\xff\xfe\x80", "é".encode(), b"z", None, b"NULL", b"", b"-1.5e3", b"", b"0x41", b"\xff\x01", b"a'b"]
    assert [r.v if r.v is None else bytes(r.v) for r in rows] == want
    assert [r.is_null for r in rows] == [w is None for w in want]


def test_any_bytes_round_trip(spark):
    rnd = random.Random(4)
    blobs = [bytes(range(256)), b"\xff\xfe\x80", b"", *(bytes(rnd.randrange(256) for _ in range(40)) for _ in range(30))]
    esc = lambda b: b.replace(b"\\", b"\\\\").replace(b"'", b"\\'").replace(b"\n", b"\\n").replace(b"\0", b"\\0")
    line = b",".join(b"(%d,_binary '%s',0x%s)" % (i, esc(b), b.hex().encode() or b"00") for i, b in enumerate(blobs))
    df = spark.createDataFrame([("m", bytearray(line))], "md5 string, b binary").select("md5", F.col("b").cast("string").alias("payload"))
    c = chunk_cells(df, ["id", "raw", "hex"]).select("row_id", "column", typed_read(F.col("value"), "binary").alias("v")).collect()
    got = {(r.row_id, r.column): bytes(r.v) for r in c}
    for i, b in enumerate(blobs):
        assert got[i, "mysql:raw"] == b and got[i, "mysql:hex"] == (b or b"\0")
