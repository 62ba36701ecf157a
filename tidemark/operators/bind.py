"""Binding row events to the table definition in force, and the events' headers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.ints import int_le, table_id, uint_le
from tidemark.operators.filters import binlog_file_number
from tidemark.schema import FORMAT_DESCRIPTION, HEADER_BYTES, ROTATE, ROW_EVENTS, TABLE_MAP
from tidemark.shipping import ship
from tidemark.sources.wire import FormatDescription, WireError, read_table_map


def header(packet: Column) -> Column:
    """The 19-byte event header as a struct, in column functions; null for shorter packets."""
    fields = F.struct(
        uint_le(packet, 4).alias("timestamp"),
        uint_le(packet, 1, 4).cast("int").alias("event_type"),
        uint_le(packet, 4, 5).alias("server_id"),
        uint_le(packet, 4, 9).alias("event_size"),
        uint_le(packet, 4, 13).alias("log_pos"),
        uint_le(packet, 2, 17).cast("int").alias("flags"),
    )
    return F.when(F.length(packet) >= HEADER_BYTES, fields)


def rotations(events: DataFrame) -> DataFrame:
    """binlog_file, next_position, next_file of the rotations."""
    rotated = events.filter(F.col("event_type") == ROTATE)
    name = F.substring(F.col("data"), 9, 2**31 - 1).cast("string")
    return rotated.select("binlog_file", int_le(F.col("data"), 8).alias("next_position"), name.alias("next_file"))


_FORMAT = "binlog_file string, binlog_version int, server_version string, create_timestamp long, common_header_len int, post_header_len array<int>"


def formats(events: DataFrame) -> DataFrame:
    """One row per format description."""
    ship(events.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [FormatDescription.read(d) for d in batch.column("data").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("binlog_file"), pa.array([r.binlog_version for r in rows], pa.int32()), pa.array([r.server_version for r in rows], pa.string()), pa.array([r.create_timestamp for r in rows], pa.int64()), pa.array([r.common_header_len for r in rows], pa.int32()), pa.array([list(r.post_header_len) for r in rows], pa.list_(pa.int32()))],
                names=["binlog_file", "binlog_version", "server_version", "create_timestamp", "common_header_len", "post_header_len"],
            )

    return events.filter(F.col("event_type") == FORMAT_DESCRIPTION).select("binlog_file", "data").mapInArrow(read, _FORMAT)


def table_maps(events: DataFrame) -> DataFrame:
    """binlog_file, start_pos and the definition of every table map; malformed ones have a null definition."""
    ship(events.sparkSession)
    struct = pa.struct([("table_id", pa.int64()), ("database", pa.string()), ("table_name", pa.string()), ("columns", pa.list_(pa.struct([("type", pa.int32()), ("meta", pa.int32())])))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data in batch.column("data").to_pylist():
                try:
                    m = read_table_map(data)
                    out.append({"table_id": m.table_id, "database": m.database, "table_name": m.table_name, "columns": [{"type": t, "meta": x} for t, x in zip(m.types, m.metas)]})
                except WireError:
                    out.append(None)
            yield pa.RecordBatch.from_arrays([batch.column("binlog_file"), batch.column("start_pos"), pa.array(out, struct)], names=["binlog_file", "start_pos", "table"])

    schema = "binlog_file string, start_pos long, table struct<table_id: long, database: string, table_name: string, columns: array<struct<type: int, meta: int>>>"
    return events.filter(F.col("event_type") == TABLE_MAP).select("binlog_file", "start_pos", "data").mapInArrow(read, schema)


def last_before(left: DataFrame, right: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """As-of join: each left row with the last right row's value at or before it; null if there is none.

    Both sides meet in one shuffle by ``by`` and one sort; no row is paired with
    more than one.
    """
    tag = right.select(*by, order, F.lit(0).alias("_side"), F.col(value).alias("_value"))
    both = left.withColumns({"_side": F.lit(1), "_value": F.lit(None).cast(right.schema[value].dataType)}).unionByName(tag, allowMissingColumns=True)
    window = Window.partitionBy(*by).orderBy(order, "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn(value, F.last("_value", ignorenulls=True).over(window)).filter("_side = 1").drop("_side", "_value")


def bind(events: DataFrame, across_files: bool = False) -> DataFrame:
    """Row events with ``table``, the last table map of their id before them, and ``version_two``.

    A server writes the table map before the rows of each statement and never
    splits a statement over files, so binding works file by file, and no key
    holds more than a file. ``across_files`` carries maps over rotations.
    """
    rows = events.filter(F.col("event_type").isin(*ROW_EVENTS)).withColumn("table_id", table_id(F.col("data")))
    maps = table_maps(events).withColumn("table_id", F.col("table.table_id"))
    if across_files:
        place = F.struct(binlog_file_number(F.col("binlog_file")).alias("n"), F.col("start_pos").alias("p"))
        bound = last_before(rows.withColumn("_at", place), maps.withColumn("_at", place), ["table_id"], "_at", "table").drop("_at")
    else:
        bound = last_before(rows, maps, ["binlog_file", "table_id"], "start_pos", "table")
    known = formats(events).select(F.col("binlog_file").alias("_file"), "post_header_len").dropDuplicates(["_file"])
    joined = bound.join(known, F.col("binlog_file") == F.col("_file"), "left")
    # without a format description the event's code tells
    ten = F.get("post_header_len", F.col("event_type") - 1) == 10
    return joined.withColumn("version_two", F.coalesce(ten, F.col("event_type") >= 30)).drop("_file", "post_header_len")


def unbound(bound: DataFrame) -> DataFrame:
    """Row events without a known table: to be set aside, they can't be decoded."""
    return bound.filter(F.col("table").isNull())
