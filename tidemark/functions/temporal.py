"""Dates and times as the log packs them, to and from text and microseconds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.ints import to_be, to_le, uint_be, uint_le


def _two(value: Column) -> Column:
    """At least two digits."""
    text = value.cast("string")
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)


def _four(value: Column) -> Column:
    return F.lpad(value.cast("string"), 4, "0")


def _bits(value: Column, shift: int, width: int) -> Column:
    return F.shiftright(value, shift).bitwiseAND(F.lit((1 << width) - 1))


def _date_text(year: Column, month: Column, day: Column) -> Column:
    return F.concat_ws("-", _four(year), _two(month), _two(day))


def _time_text(hour: Column, minute: Column, second: Column) -> Column:
    return F.concat_ws(":", _two(hour), _two(minute), _two(second))


def fraction_bytes(fsp: int) -> int:
    return (fsp + 1) // 2


def micros_text(micros: Column) -> Column:
    """Six digits behind a point; nothing for 0."""
    return F.when(micros == 0, "").otherwise(F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0")))


def decode_fraction(data: Column, fsp: int, offset: int) -> Column:
    """Microseconds of the fraction behind a packed time; more than six digits count as none."""
    width = fraction_bytes(fsp)
    if not 0 < fsp <= 6:
        return F.lit(0).cast("long")
    return uint_be(data, width, offset) * 10 ** (6 - 2 * width)


def encode_fraction(micros: Column, fsp: int) -> Column:
    width = fraction_bytes(fsp)
    return to_be(F.floor(micros / 10 ** (6 - 2 * width)), width) if width else F.unhex(F.lit(""))


def decode_date(data: Column) -> Column:
    """Three bytes to YYYY-MM-DD; zero parts stay zero."""
    v = uint_le(data, 3)
    return _date_text(_bits(v, 9, 15), _bits(v, 5, 4), _bits(v, 0, 5))


def encode_date(date: Column) -> Column:
    return to_le(F.year(date) * 512 + F.month(date) * 32 + F.dayofmonth(date), 3)


def date_value(text: Column) -> Column:
    """A date column from text; null for dates that are none."""
    return F.substring(text, 1, 10).try_cast("date")


def decode_datetime2(data: Column, fsp: int = 0) -> Column:
    """Five bytes and a fraction to YYYY-MM-DD HH:MM:SS[.ffffff]."""
    v = uint_be(data, 5) - (1 << 39)
    ym = _bits(v, 22, 17)
    date = _date_text(F.floor(ym / 13), F.pmod(ym, F.lit(13)), _bits(v, 17, 5))
    time = _time_text(_bits(v, 12, 5), _bits(v, 6, 6), _bits(v, 0, 6))
    text = F.concat(date, F.lit(" "), time, micros_text(decode_fraction(data, fsp, 5)))
    return F.when(v <= 0, F.concat(F.lit("0000-00-00 00:00:00"), micros_text(decode_fraction(data, fsp, 5)))).otherwise(text)


def encode_datetime2(ts: Column, fsp: int = 0) -> Column:
    day = (F.year(ts) * 13 + F.month(ts)) * 32 + F.dayofmonth(ts)
    time = (F.hour(ts) * 64 + F.minute(ts)) * 64 + F.second(ts)
    return F.concat(to_be(day.cast("long") * (1 << 17) + time + (1 << 39), 5), encode_fraction(_micros(ts), fsp))


def _micros(ts: Column) -> Column:
    return F.date_format(ts, "SSSSSS").cast("long")


def decode_datetime_legacy(data: Column) -> Column:
    """Eight bytes that hold the decimal number YYYYMMDDHHMMSS."""
    v = uint_le(data, 7)
    part = lambda power: F.pmod(F.floor(v / 100**power), F.lit(100))
    return F.concat(_date_text(F.floor(v / 100**5), part(4), part(3)), F.lit(" "), _time_text(part(2), part(1), part(0)))


def decode_timestamp(data: Column) -> Column:
    """Four little-endian bytes of seconds to microseconds."""
    return uint_le(data, 4) * 1_000_000


def decode_timestamp2(data: Column, fsp: int = 0) -> Column:
    """Four big-endian bytes of seconds and a fraction to microseconds."""
    return uint_be(data, 4) * 1_000_000 + decode_fraction(data, fsp, 4)


def encode_timestamp2(micros: Column, fsp: int = 0) -> Column:
    return F.concat(to_be(F.floor(micros / 1_000_000), 4), encode_fraction(F.pmod(micros, F.lit(1_000_000)), fsp))


def timestamp_text(micros: Column) -> Column:
    """Microseconds since 1970 to YYYY-MM-DDTHH:MM:SS[.ffffff]Z, whatever the session's zone."""
    days = F.floor(micros / 86_400_000_000)
    rest = micros - days * 86_400_000_000
    seconds = F.floor(rest / 1_000_000)
    date = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), days.cast("int")), "yyyy-MM-dd")
    time = _time_text(F.floor(seconds / 3600), F.pmod(F.floor(seconds / 60), F.lit(60)), F.pmod(seconds, F.lit(60)))
    return F.concat(date, F.lit("T"), time, micros_text(F.pmod(micros, F.lit(1_000_000))), F.lit("Z"))


def datetime_text(ts: Column) -> Column:
    """A timestamp column as YYYY-MM-DD HH:MM:SS[.ffffff]."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), micros_text(_micros(ts)))


def duration_text(micros: Column) -> Column:
    """Signed microseconds to [-]HH:MM:SS[.ffffff], hours as many as there are."""
    size = F.abs(micros)
    seconds = F.floor(size / 1_000_000)
    time = _time_text(F.floor(seconds / 3600), F.pmod(F.floor(seconds / 60), F.lit(60)), F.pmod(seconds, F.lit(60)))
    return F.concat(F.when(micros < 0, "-").otherwise(""), time, micros_text(F.pmod(size, F.lit(1_000_000))))


def decode_time(data: Column) -> Column:
    """Three bytes that hold the signed decimal number HHMMSS, to microseconds."""
    v = uint_le(data, 3)
    v = v - F.when(v >= 1 << 23, F.lit(1 << 24)).otherwise(F.lit(0))
    size = F.abs(v)
    seconds = F.floor(size / 10_000) * 3600 + F.pmod(F.floor(size / 100), F.lit(100)) * 60 + F.pmod(size, F.lit(100))
    return F.when(v < 0, -seconds).otherwise(seconds) * 1_000_000


def decode_time2(data: Column, fsp: int = 0) -> Column:
    """Three bytes and a fraction, biased as one number, to signed microseconds."""
    width = 3 + fraction_bytes(fsp)
    v = uint_be(data, width) - (1 << (8 * width - 1))
    size, unit = F.abs(v), 1 << (8 * fraction_bytes(fsp))
    whole, rest = F.floor(size / unit), F.pmod(size, F.lit(unit))
    micros = (_bits(whole, 12, 10) * 3600 + _bits(whole, 6, 6) * 60 + _bits(whole, 0, 6)) * 1_000_000 + rest * 10 ** (6 - 2 * fraction_bytes(fsp))
    return F.when(v < 0, -micros).otherwise(micros)


def encode_time2(micros: Column, fsp: int = 0) -> Column:
    size, width = F.abs(micros), fraction_bytes(fsp)
    seconds = F.floor(size / 1_000_000)
    packed = F.floor(seconds / 3600) * 4096 + F.pmod(F.floor(seconds / 60), F.lit(60)) * 64 + F.pmod(seconds, F.lit(60))
    packed = packed * (1 << (8 * width)) + F.floor(F.pmod(size, F.lit(1_000_000)) / 10 ** (6 - 2 * width))
    return to_be(F.when(micros < 0, -packed).otherwise(packed) + (1 << (8 * (3 + width) - 1)), 3 + width)


def duration_value(micros: Column) -> Column:
    """A day-time interval column."""
    return F.make_dt_interval(secs=(micros / 1_000_000).cast("decimal(18,6)"))


def decode_year(data: Column) -> Column:
    """One byte from 1900; 0 is the year 0."""
    v = uint_le(data, 1)
    return F.when(v == 0, 0).otherwise(v + 1900)
