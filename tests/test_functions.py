import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import decimal, ints, temporal, text
from tidemark.sources import encode, wire


def column(spark, value, kind, f):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v"))).first()[0]


@pytest.mark.parametrize("raw,p,s,shown", [("807B2D", 5, 2, "123.45"), ("800000000000053C0FA0", 21, 4, "1340.4000"), ("8000000000", 10, 2, "0.00"), ("7F84D2", 5, 2, "-123.45"), ("80000F4240", 10, 0, "1000000"), ("8000000001", 10, 4, "0.0001")])
def test_decimal_columns(spark, raw, p, s, shown):
    assert column(spark, bytes.fromhex(raw), "binary", lambda c: decimal.decode_decimal(c, p, s)) == shown
    assert column(spark, shown, "string", lambda c: F.hex(decimal.encode_decimal(c, p, s))) == raw
    assert decimal.decimal_bytes(p, s) == len(raw) // 2


def test_long_decimals(spark):
    for p, s in ((65, 30), (38, 0), (30, 30), (18, 9)):
        texts = ["-" * n + ("1234567890" * 7)[: p - s].rjust(1, "0") + ("." + ("0987654321" * 3)[:s] if s else "") for n in (0, 1)]
        df = spark.createDataFrame([(t, encode.decimal(t, p, s)) for t in texts], "t string, b binary")
        for r in df.select("t", decimal.decode_decimal(F.col("b"), p, s).alias("d"), decimal.encode_decimal(F.col("t"), p, s).alias("e"), "b").collect():
            assert r.d == wire.decimal_text(bytes(r.b), p, s) and bytes(r.e) == bytes(r.b)


def test_ints(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, -1, 8388607, -8388608, 2**40 + 5)], "v long")
    v = F.col("v")
    for r in df.select("v", ints.int_le(ints.to_le(v, 8), 8).alias("le"), ints.uint_le(ints.to_le(v, 6), 6).alias("u6"), ints.int24(ints.to_le(v, 3)).alias("i24"), ints.uint_be(ints.to_be(v, 4), 4).alias("be")).collect():
        assert r.le == r.v and r.u6 == r.v % 2**48 and r.be == r.v % 2**32
        assert r.i24 == (r.v + 2**23) % 2**24 - 2**23


def test_lenenc_and_metas(spark):
    for n in (0, 250, 251, 65535, 65536, 2**24):
        got = column(spark, encode.lenenc(n), "binary", ints.lenenc_int)
        assert (got.value, got.width) == (n, len(encode.lenenc(n)))
    assert column(spark, b"\xfb", "binary", ints.lenenc_int).value is None
    for meta in (0xFE0A, 0xF701, 0xF802, 0xEE2C, 0xCE00):
        assert tuple(column(spark, meta, "int", ints.string_meta)) == wire._string_meta(meta)
    assert [column(spark, m, "int", ints.bit_bytes) for m in (0x0001, 0x0100, 0x0101, 0x0800)] == [1, 1, 2, 8]
    assert [column(spark, b"\x05\x80", "binary", lambda c, k=k: ints.bit_is_set(c, k)) for k in (0, 1, 2, 15)] == [True, False, True, True]


@pytest.mark.parametrize("fsp", range(7))
def test_times(spark, fsp):
    keep = 10 ** (6 - 2 * ((fsp + 1) // 2))
    t = datetime.datetime(2024, 12, 25, 10, 30, 45, 123456 // keep * keep)
    df = spark.createDataFrame([(t, -3_723_123_456 // keep * keep)], "t timestamp, d long")
    r = df.select(
        F.hex(temporal.encode_datetime2(F.col("t"), fsp)).alias("e"),
        temporal.decode_datetime2(temporal.encode_datetime2(F.col("t"), fsp), fsp).alias("dt"),
        temporal.decode_time2(temporal.encode_time2(F.col("d"), fsp), fsp).alias("d2"),
        F.hex(temporal.encode_time2(F.col("d"), fsp)).alias("te"),
        temporal.duration_text(F.col("d")).alias("dur"),
        temporal.timestamp_text(temporal.decode_timestamp2(temporal.encode_timestamp2(F.unix_micros("t"), fsp), fsp)).alias("ts"),
    ).first()
    assert r.e == encode.datetime2(2024, 12, 25, 10, 30, 45, t.microsecond, fsp).hex().upper()
    assert r.dt == wire.value_json(wire.read_value(wire.Cursor(bytes.fromhex(r.e)), 18, fsp)).strip('"')
    d = -3_723_123_456 // keep * keep
    assert r.d2 == d and r.te == encode.time2(d, fsp).hex().upper() and r.dur == wire._clock(d)
    assert r.ts == wire.value_json(wire.Value("timestamp", int(t.replace(tzinfo=datetime.timezone.utc).timestamp()) * 10**6 + t.microsecond)).strip('"')


def test_other_times(spark):
    assert column(spark, (2024 << 9 | 12 << 5 | 25).to_bytes(3, "little"), "binary", temporal.decode_date) == "2024-12-25"
    assert column(spark, b"\0\0\0", "binary", temporal.decode_date) == "0000-00-00"
    assert column(spark, "0000-00-00", "string", temporal.date_value) is None
    assert column(spark, (20241225103000).to_bytes(8, "little"), "binary", temporal.decode_datetime_legacy) == "2024-12-25 10:30:00"
    assert column(spark, b"\0" * 8, "binary", lambda c: temporal.decode_datetime2(F.concat(F.lit(b"\x80\0\0\0\0"), F.substring(c, 1, 3)), 6)) == "0000-00-00 00:00:00"
    assert column(spark, (-10001).to_bytes(3, "little", signed=True), "binary", temporal.decode_time) == -3_601_000_000
    assert column(spark, b"\x7c", "binary", temporal.decode_year) == 2024 and column(spark, b"\0", "binary", temporal.decode_year) == 0
    assert column(spark, b"\x80\x51\x01\x00", "binary", temporal.decode_timestamp) == 86_400_000_000
    assert column(spark, 838 * 3600 * 10**6, "long", temporal.duration_text) == "838:00:00"
    assert column(spark, -1_500_000, "long", temporal.duration_value) == datetime.timedelta(seconds=-1.5)


@pytest.mark.parametrize("x,shown", [(1e-7, "0.0000001"), (1e7, "10000000"), (1.5e10, "15000000000"), (-0.5, "-0.5"), (100.0, "100"), (1234567.25, "1234567.25"), (1.2345678901e9, "1234567890.1"), (0.0, "0"), (1e300, "1" + "0" * 300), (2.5e-10, "0.00000000025"), (None, None)])
def test_number_text(spark, x, shown):
    assert column(spark, x, "double", text.number_text) == shown


def test_number_text_of_others(spark):
    assert column(spark, 5, "long", text.number_text) == "5"
    assert spark.range(1).select(text.number_text(F.lit(0.1).cast("float"))).first()[0] == "0.1"


@pytest.mark.parametrize("raw", [b'hello "world"\n', b"a\\/\x08\x1f\xc3\xa9", b"\xff", b"ok\xc3(\xe2\x82\xacx\xff", b"", b"\r\t\x00"])
def test_escapes(spark, raw):
    assert column(spark, raw, "binary", text.json_escape_bytes) == wire.escape(raw)


def test_blobs_and_rows(spark):
    assert column(spark, b"\x00\xff", "binary", text.hex_literal) == "0x00ff"
    assert column(spark, b"\1" * 300, "binary", text.blob_preview) == "<300 bytes> 0x" + "01" * 32 + "..."
    assert column(spark, 42, "int", lambda c: text.row_json([c.cast("string"), F.lit(None)])) == '{"c0":42,"c1":null}'
