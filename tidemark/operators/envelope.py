"""Projections onto the change row: kind of change, images, names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.schema import DML, ENVELOPE, EVENT_NAMES, TYPE_NAMES


def _lookup(names: dict[int, str], code: Column, otherwise: Column) -> Column:
    table = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    return F.coalesce(F.element_at(table, code), otherwise)


def dml_type(event_type: Column) -> Column:
    """INSERT, UPDATE or DELETE for a row event's code; null for others."""
    return _lookup(DML, event_type, F.lit(None).cast("string"))


def event_name(event_type: Column) -> Column:
    return _lookup(EVENT_NAMES, event_type, F.lit("UNKNOWN_EVENT"))


def type_name(type_code: Column) -> Column:
    return _lookup(TYPE_NAMES, type_code, F.lit("UNKNOWN"))


def is_artificial_rotate(next_position: Column) -> Column:
    """A rotation that the server makes up when a stream begins."""
    return next_position.isin(0, 4)


def with_images(df: DataFrame, dml: Column, before: Column, after: Column) -> DataFrame:
    """dml_type and the two images: an insert has none before, a delete none after."""
    return df.withColumns({"dml_type": dml, "before_values": F.when(dml != "INSERT", before), "after_values": F.when(dml != "DELETE", after)})


def to_envelope(df: DataFrame) -> DataFrame:
    """The nine columns, in order, with their types; required ones are checked."""
    out = []
    for f in ENVELOPE.fields:
        value = F.col(f.name).cast(f.dataType)
        out.append((value if f.nullable else F.coalesce(value, F.raise_error(F.lit(f"{f.name} is null")).cast(f.dataType))).alias(f.name))
    return df.select(*out)
