"""Integers in byte order, from and to binary columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _pairs(hexed: Column, width: int, backwards: bool) -> Column:
    order = range(width, 0, -1) if backwards else range(1, width + 1)
    return F.concat(*(F.substring(hexed, 2 * k - 1, 2) for k in order))


def hex_to_long(digits: Column) -> Column:
    """Hex digits, at most 16, as a long; 16 of them in two's complement."""
    return F.conv(digits, 16, -10).cast("long")


def uint_le(data: Column, width: int, offset: int = 0) -> Column:
    """Little-endian unsigned integer of up to 7 bytes at an offset."""
    return hex_to_long(_pairs(F.hex(F.substring(data, offset + 1, width)), width, True))


def int_le(data: Column, width: int, offset: int = 0) -> Column:
    """Little-endian two's complement integer of up to 8 bytes."""
    # the value is named once, for what names it twice computes it twice
    return F.shiftright(F.shiftleft(uint_le(data, width, offset), 64 - 8 * width), 64 - 8 * width)


def uint_be(data: Column, width: int, offset: int = 0) -> Column:
    """Big-endian unsigned integer of up to 7 bytes at an offset."""
    return hex_to_long(F.hex(F.substring(data, offset + 1, width)))


def int24(data: Column, offset: int = 0) -> Column:
    return int_le(data, 3, offset)


def table_id(data: Column) -> Column:
    """The six-byte id that table maps and row events begin with."""
    return uint_le(data, 6)


def lenenc_int(data: Column, offset: int = 0) -> Column:
    """Length-encoded integer: struct of value and width; null for the null and error marks."""
    first = uint_le(data, 1, offset)
    value = (
        F.when(first < 251, first)
        .when(first == 252, uint_le(data, 2, offset + 1))
        .when(first == 253, uint_le(data, 3, offset + 1))
        .when(first == 254, int_le(data, 8, offset + 1))
    )
    width = F.when(first < 251, 1).when(first == 252, 3).when(first == 253, 4).when(first == 254, 9).otherwise(1)
    return F.struct(value.alias("value"), width.alias("width"))


def to_le(value: Column, width: int) -> Column:
    """The lowest bytes of an integer, least first."""
    digits = F.lpad(F.hex(value.cast("long")), 16, "0")
    return F.unhex(F.concat(*(F.substring(digits, 17 - 2 * k, 2) for k in range(1, width + 1))))


def to_be(value: Column, width: int) -> Column:
    return F.unhex(F.substring(F.lpad(F.hex(value.cast("long")), 16, "0"), 17 - 2 * width, 2 * width))


def bit_bytes(meta: Column) -> Column:
    """Bytes of a BIT column from its metadata: whole bytes high, left-over bits low."""
    return F.shiftright(meta, 8) + F.when(meta.bitwiseAND(F.lit(255)) > 0, 1).otherwise(0)


def string_meta(meta: Column) -> Column:
    """Real type and length of a STRING column, unfolded from its big-endian metadata."""
    high, low = F.shiftright(meta, 8), meta.bitwiseAND(F.lit(255))
    folded = high.bitwiseAND(F.lit(0x30)) != 0x30
    real = F.when(folded, high.bitwiseOR(F.lit(0x30))).otherwise(high)
    length = F.when(folded, low.bitwiseOR(F.shiftleft(high.bitwiseAND(F.lit(0x30)).bitwiseXOR(F.lit(0x30)), 4))).otherwise(low)
    return F.struct(real.alias("type"), length.alias("length"))


def bit_is_set(bitmap: Column, index: int) -> Column:
    """Bit of a null or presence bitmap, counted from the first byte's lowest."""
    return F.shiftright(uint_le(bitmap, 1, index // 8), index % 8).bitwiseAND(F.lit(1)) == 1
