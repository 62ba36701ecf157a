"""Text of values, as the change rows' JSON and the text sink write it."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Bytes over which the text sink shows the size and the first bytes only.
PREVIEW_OVER, PREVIEW_BYTES = 256, 32


def number_text(value: Column) -> Column:
    """A number in plain decimals: never an exponent, no trailing .0."""
    text = value.cast("string")
    # numbers with an exponent are rare: they alone take the long way, outside generated code
    spread = F.element_at(F.transform(F.array(text), _without_exponent), 1)
    return F.when(text.contains("E"), spread).otherwise(F.regexp_replace(text, r"\.0$", ""))


def _without_exponent(text: Column) -> Column:
    form = r"^-?([0-9]+)\.?([0-9]*)E(-?[0-9]+)$"
    mantissa = F.regexp_extract(text, form, 1)
    digits = F.concat(mantissa, F.regexp_replace(F.regexp_extract(text, form, 2), "0+$", ""))
    point = F.length(mantissa) + F.regexp_extract(text, form, 3).cast("int")
    large = F.rpad(digits, point, "0")
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits)
    middle = F.concat(F.substr(digits, F.lit(1), point), F.lit("."), F.substr(digits, point + 1))
    plain = F.when(point >= F.length(digits), large).when(point <= 0, small).otherwise(middle)
    return F.concat(F.when(text.startswith("-"), "-").otherwise(""), plain)


def json_escape(text: Column) -> Column:
    """Escapes quotes, backslashes and control characters; all else stays."""
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for char, name in (("\n", "n"), ("\r", "r"), ("\t", "t")):
        out = F.replace(out, F.lit(char), F.lit(f"\\{name}"))
    rare = out
    for code in range(0x20):
        if chr(code) not in "\n\r\t":
            rare = F.replace(rare, F.lit(chr(code)), F.lit(f"\\u{code:04x}"))
    # control characters are rare: one test saves 29 passes
    return F.when(out.rlike(r"[\x00-\x1f]"), rare).otherwise(out)


def json_escape_bytes(data: Column) -> Column:
    """json_escape of binary; each byte that is no UTF-8 becomes \\u00xx.

    Valid binary takes the fast way; broken binary is read byte by byte as
    Latin-1 pieces between its valid stretches.
    """
    latin = F.decode(data, "ISO-8859-1")
    valid = r"(?:[\x00-\x7f]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xef][\x80-\xbf]{2}|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2})"
    pieces = F.regexp_extract_all(latin, F.lit(f"{valid}+|[\\x80-\\xff]"), F.lit(0))
    whole = F.lit(f"^{valid}+$")
    piece = lambda p: F.when(F.regexp_like(p, whole), json_escape(F.decode(F.encode(p, "ISO-8859-1"), "UTF-8"))).otherwise(F.concat(F.lit("\\u00"), F.lower(F.hex(F.encode(p, "ISO-8859-1")))))
    return F.when(F.is_valid_utf8(data.cast("string")), json_escape(data.cast("string"))).otherwise(F.array_join(F.transform(pieces, piece), ""))


def quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


def json_string(text: Column) -> Column:
    return quoted(json_escape(text))


def hex_literal(data: Column) -> Column:
    """0x and lower-case hex."""
    return F.concat(F.lit("0x"), F.lower(F.hex(data)))


def blob_preview(data: Column) -> Column:
    """Hex of short binary; the size and the first bytes of long."""
    start = F.concat(F.lower(F.hex(F.substring(data, 1, PREVIEW_BYTES))), F.lit("..."))
    long = F.concat(F.lit("<"), F.length(data).cast("string"), F.lit(" bytes> 0x"), start)
    return F.when(F.length(data) > PREVIEW_OVER, long).otherwise(hex_literal(data))


def row_json(values: list[Column]) -> Column:
    """An object with keys c0, c1, … from columns that hold JSON text; null becomes null."""
    parts = [F.concat(F.lit(f'"c{k}":'), F.coalesce(v, F.lit("null"))) for k, v in enumerate(values)]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
