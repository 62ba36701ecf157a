"""Packed decimals: nine digits in four bytes, fewer in as many as they need."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Bytes that hold 0 to 9 digits.
BYTES_OF_DIGITS = (0, 1, 1, 2, 2, 3, 3, 4, 4, 4)
_FLIPPED = ("0123456789ABCDEF", "FEDCBA9876543210")


def groups(digits: int, short_first: bool) -> list[int]:
    """Digits of each group; the short one stands first before the point, last behind it."""
    full, short = divmod(digits, 9)
    sizes = [9] * full
    if short:
        sizes.insert(0 if short_first else full, short)
    return sizes


def decimal_bytes(precision: int, scale: int) -> int:
    return sum(BYTES_OF_DIGITS[g] for g in (*groups(precision - scale, True), *groups(scale, False)))


def decode_decimal(data: Column, precision: int, scale: int) -> Column:
    """Packed bytes to text with all digits of the scale; text holds what no Spark decimal can."""
    digits = F.hex(data)
    # the top bit is set for numbers from 0 up; negative ones have all other bits flipped
    negative = F.substring(digits, 1, 1) < "8"
    plain = F.when(negative, F.translate(digits, *_FLIPPED)).otherwise(digits)
    top = F.substring(F.conv(plain.substr(1, 1), 16, 16), 1, 1)
    cleared = F.translate(top, "89ABCDEF", "01234567")
    plain = F.concat(cleared, F.substring(plain, 2, 2 * decimal_bytes(precision, scale)))
    at, parts = 1, []
    for sizes in (groups(precision - scale, True), groups(scale, False)):
        text = []
        for size in sizes:
            width = 2 * BYTES_OF_DIGITS[size]
            text.append(F.lpad(F.conv(F.substring(plain, at, width), 16, 10), size, "0"))
            at += width
        parts.append(F.concat(*text) if text else F.lit(""))
    whole = F.ltrim(parts[0], F.lit("0"))
    number = F.when(whole == "", "0").otherwise(whole)
    if scale:
        number = F.concat(number, F.lit("."), parts[1])
    return F.concat(F.when(negative, "-").otherwise(""), number)


def encode_decimal(text: Column, precision: int, scale: int) -> Column:
    """Decimal text with exactly ``scale`` digits behind the point to packed bytes."""
    negative = text.startswith("-")
    plain = F.ltrim(text, F.lit("-"))
    whole = F.lpad(F.substring_index(plain, ".", 1), max(1, precision - scale), "0")
    behind = F.substring_index(plain, ".", -1) if scale else F.lit("")
    out = []
    for digits, sizes in ((whole, groups(precision - scale, True)), (behind, groups(scale, False))):
        at = 1
        for size in sizes:
            out.append(F.lpad(F.conv(F.substring(digits, at, size), 10, 16), 2 * BYTES_OF_DIGITS[size], "0"))
            at += size
    packed = F.concat(*out)
    packed = F.concat(F.translate(F.substring(packed, 1, 1), "01234567", "89ABCDEF"), F.substring(packed, 2, 2 * decimal_bytes(precision, scale)))
    return F.unhex(F.when(negative, F.translate(packed, *_FLIPPED)).otherwise(packed))
