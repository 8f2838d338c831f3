"""Images, wire forms, key bytes and buckets."""

import math
import random
import struct
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import buckets, ieee754
from tidemark.functions.keybytes import key_bytes
from tidemark.operators import decode

RECORD = (
    "op string, before struct<k:int,v:string>, after struct<k:int,v:string>,"
    " txn struct<id:string,total_order:bigint,collection_order:bigint>"
)


def test_image_selection(spark):
    before, after, txn = (1, "b"), (1, "a"), ("t", 5, 6)
    records = [
        ("INSERT", before, after, txn),
        ("SNAPSHOT", None, after, txn),
        ("INSERT", before, None, txn),
        ("UPDATE", before, after, None),
        ("UPDATE", before, None, txn),
        ("UPDATE", None, None, txn),
        ("DELETE", before, after, txn),
        ("DELETE", None, after, txn),
        ("TRUNCATE", before, after, txn),
        (None, before, after, txn),
    ]
    flat = decode.flatten_changes(spark.createDataFrame(records, RECORD))
    assert rows(flat, "_op", "v", "_txn_id", "_total_order", "_collection_order") == [
        ("DELETE", "b", "t", 5, 6),
        ("INSERT", "a", "t", 5, 6),
        ("SNAPSHOT", "a", "t", 5, 6),
        ("UPDATE", "a", None, None, None),
        ("UPDATE", "b", "t", 5, 6),
    ]
    assert decode.business_columns(flat).columns == ["k", "v"]


WIRE = T.StructType(
    [
        T.StructField("i", T.IntegerType()),
        T.StructField("l", T.LongType()),
        T.StructField("f", T.FloatType()),
        T.StructField("d", T.DoubleType()),
        T.StructField("s", T.StringType()),
        T.StructField("b", T.BinaryType()),
        T.StructField("o", T.BooleanType()),
        T.StructField("day", T.DateType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("ntz", T.TimestampNTZType()),
        T.StructField("m", T.DecimalType(12, 2)),
    ]
)


def wire_records(spark, *images):
    schema = "op string, before array<binary>, after array<binary>, txn struct<id:string,total_order:bigint,collection_order:bigint>"
    return spark.createDataFrame([("INSERT", None, image, None) for image in images], schema)


def micros(moment):
    return (moment - datetime(1970, 1, 1)) // timedelta(microseconds=1)


def test_wire_values(spark):
    early = datetime(1969, 12, 31, 23, 59, 59, 999999)
    image = [
        struct.pack(">i", -2),
        struct.pack(">q", -3),
        struct.pack(">f", 1.5),
        struct.pack(">d", -2.25),
        "naïve".encode(),
        b"\x00\xff",
        b"TRUE",
        struct.pack(">i", -1),
        struct.pack(">q", micros(early)),
        struct.pack(">q", micros(early)),
        b"-12.345",
    ]
    other = [b"", b"", struct.pack(">f", math.inf), struct.pack(">d", 5e-324), b"", b"", b"yes"]
    got = decode.decode_changes(wire_records(spark, image, other), WIRE)
    assert [f.name for f in got.schema.fields[: len(WIRE)]] == WIRE.names
    first, second = sorted(got.collect(), key=lambda r: r.i is None)
    assert (first.i, first.l, first.f, first.d, first.s, bytes(first.b), first.o) == (
        -2, -3, 1.5, -2.25, "naïve", b"\x00\xff", True,
    )
    assert first.day == date(1969, 12, 31) and first.ntz == early
    assert got.select(F.unix_micros("ts")).where("ts is not null").first()[0] == -1
    assert first.m == Decimal("-12.35")
    assert (second.i, second.l, second.f, second.d, second.s, second.b, second.o) == (
        None, None, math.inf, 5e-324, None, None, False,
    )
    assert (second.day, second.ts, second.ntz, second.m) == (None, None, None, None)


def test_wire_roundtrip_of_random_rows(spark):
    source = random.Random(7)
    made = []
    for n in range(200):
        moment = datetime(1970, 1, 1) + timedelta(microseconds=source.randrange(-(10**15), 2 * 10**15))
        row = (
            source.randrange(-(2**31), 2**31), source.randrange(-(2**63), 2**63),
            struct.unpack(">f", struct.pack(">f", source.gauss(0, 1e6)))[0], source.gauss(0, 1e100),
            "x" * n + "é", source.randbytes(n) or b"z", source.random() < 0.5, moment.date(), moment, moment,
            Decimal(source.randrange(-(10**11), 10**11)) / 100,
        )
        made.append(tuple(None if source.random() < 0.1 else v for v in row))
    df = spark.createDataFrame(made, WIRE).repartition(4)
    encoded = decode.encode_image(df, WIRE, "after").select(
        F.lit("INSERT").alias("op"),
        F.lit(None).cast("array<binary>").alias("before"),
        "after",
        F.lit(None).cast("struct<id:string,total_order:bigint,collection_order:bigint>").alias("txn"),
    )
    back = decode.decode_changes(encoded, WIRE).select(*WIRE.names)
    assert df.exceptAll(back).isEmpty() and back.exceptAll(df).isEmpty()


def test_wire_rejects_bad_input(spark):
    with pytest.raises(TypeError, match="wire form"):
        decode.decode_changes(wire_records(spark, [b"a"]), T.StructType([T.StructField("x", T.ShortType())]))
    one = T.StructType([T.StructField("x", T.LongType())])
    with pytest.raises(Exception, match="shorter"):
        decode.decode_changes(wire_records(spark, [b"abc"]), one).collect()


def test_double_bits_are_exact(spark):
    source = random.Random(1)
    values = [0.0, -0.0, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, math.inf, -math.inf, math.nan, None]
    for k in range(-1074, 1024, 3):
        values += [math.ldexp(1.0, k), -math.nextafter(math.ldexp(1.0, k), 0), math.nextafter(math.ldexp(1.0, k), math.inf)]
    values += [struct.unpack(">d", struct.pack(">Q", source.getrandbits(64)))[0] for _ in range(500)]

    def want(v):
        if v is None or v != v:
            return None if v is None else 0x7FF8 << 48
        return struct.unpack(">q", struct.pack(">d", v))[0]

    df = spark.createDataFrame([(v,) for v in values], "v double")
    for v, bits in df.select("v", ieee754.to_bits(F.col("v"), "double")).collect():
        assert bits == want(v), v


def test_key_bytes_by_type(spark):
    schema = (
        "o boolean, y tinyint, h smallint, i int, l bigint, d date, t timestamp, f float, w double,"
        " m decimal(10,2), g decimal(30,4), s string, b binary"
    )
    moment = datetime(1969, 12, 31, 23, 59, 59, 500000)
    big = Decimal("-12345678901234567890123456.7891")
    row = (True, -1, -2, -3, -4, date(1969, 12, 30), moment, -1.5, 1e-310, Decimal("-1.25"), big, "é|", b"\x01")
    df = spark.createDataFrame([row], schema)
    want = {
        "o": b"\x01", "y": b"\xff", "h": struct.pack(">i", -2), "i": struct.pack(">i", -3),
        "l": struct.pack(">q", -4), "d": struct.pack(">i", -2), "f": struct.pack(">f", -1.5),
        "w": struct.pack(">d", 1e-310), "m": struct.pack(">q", -125),
        "g": int(str(big).replace(".", "")).to_bytes(16, "big", signed=True), "s": "é|".encode(), "b": b"\x01",
    }
    for name, value in want.items():
        assert bytes(df.select(key_bytes(df, [name])).first()[0]) == value, name
    micros_of_t = df.select(F.unix_micros("t")).first()[0]
    assert bytes(df.select(key_bytes(df, ["t"])).first()[0]) == struct.pack(">q", micros_of_t)
    for moment in (datetime(1969, 12, 31, 23, 59, 59, 500000), datetime(2024, 5, 6, 17, 8, 9, 123456)):
        ntz = spark.createDataFrame([(moment,)], "n timestamp_ntz")
        assert bytes(ntz.select(key_bytes(ntz, ["n"])).first()[0]) == struct.pack(">q", micros(moment))
    assert bytes(df.select(key_bytes(df, ["s", "i"])).first()[0]) == want["s"] + want["i"]


def test_null_key_is_an_error(spark):
    df = spark.createDataFrame([(None,)], "k int")
    with pytest.raises(Exception, match="no value in its key column k"):
        df.select(key_bytes(df, ["k"])).collect()
    for fn in ("xxhash64", "md5", "murmur3", "key_bytes"):
        with pytest.raises(Exception, match="no value in its key column k"):
            buckets.with_bucket(df, ["k"], 4, fn).collect()
    assert 0 <= buckets.with_bucket(df, ["k"], 4, "spark_hash").first()["_bucket"] < 4


def test_bucket_arguments(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    assert buckets.with_bucket(df, ["k"], 0).columns == ["k", "v"]
    assert buckets.with_bucket(df, ["k"], 0, "spark_hash").first()["_bucket"] == 0
    with pytest.raises(ValueError, match="not found"):
        buckets.with_bucket(df, ["missing"], 4)
    with pytest.raises(ValueError, match="bucket_fn"):
        buckets.with_bucket(df, ["k"], 4, "crc")
    with pytest.raises(ValueError, match="at least one"):
        buckets.with_bucket(df, [], 4)


def test_spark_hash_matches_its_definition(spark):
    df = spark.range(50).selectExpr("id", "cast(id % 7 as string) s")
    want = F.pmod(F.hash(F.coalesce(F.col("id").cast("string"), F.lit("")), F.coalesce("s", F.lit(""))), F.lit(5))
    got = buckets.with_bucket(df, ["id", "s"], 5, "spark_hash").withColumn("want", want)
    assert got.where("_bucket <> want").isEmpty()


def test_sql_bucket_function(spark):
    buckets.register_bucket_function(spark, "b_of", {"k": "bigint", "s": "string"}, 8)
    df = spark.range(20).selectExpr("id as k", "cast(id as string) as s")
    both = buckets.with_bucket(df, ["k", "s"], 8).withColumn("sql", F.expr("b_of(k, s)"))
    assert both.where("_bucket <> sql").isEmpty()


def test_ranges():
    assert buckets.parse_ranges(" 0-3, 8,3 ") == [0, 1, 2, 3, 8]
    assert buckets.parse_ranges(None) == []
    for bad in ("3-1", "-3", "3-", "1-2-3", "x"):
        with pytest.raises(ValueError, match="neither a bucket number"):
            buckets.parse_ranges(bad)
