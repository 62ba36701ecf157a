"""Predicates on events and change rows. All are plain columns, so Catalyst pushes them to the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.schema import HEADER_BYTES, KEPT_EVENTS
from tidemark.spec import CaptureSpec, Pattern, TableRules, file_number


def kept_event(event_type: Column) -> Column:
    """Rotations, format descriptions, table maps and row events."""
    return event_type.isin(*KEPT_EVENTS)


def whole_packet(packet: Column) -> Column:
    """Long enough to hold an event header."""
    return F.length(packet) >= HEADER_BYTES


def _any_of(patterns: list[Pattern], database: Column, table: Column) -> Column:
    """One disjunct per schema, so that lists of tables become IN lists."""
    by_schema: dict[str | None, list[str]] = {}
    for p in patterns:
        by_schema.setdefault(p.schema, [])
        if p.table:
            by_schema[p.schema].append(p.table)
    out = F.lit(False)
    for schema, tables in by_schema.items():
        one = F.lit(True) if schema is None else database == schema
        out = out | (one & table.isin(*tables) if tables else one)
    return out


def admitted(rules: TableRules, database: Column, table: Column) -> Column:
    """Whether the rules let a table through; never null."""
    verdict: Column | None = None
    for patterns, says in rules.levels():
        if patterns:
            fits = _any_of(patterns, database, table)
            verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    return F.lit(rules.otherwise) if verdict is None else verdict.otherwise(rules.otherwise)


def binlog_file_number(name: Column) -> Column:
    """The integer after the last dot; null if there is none."""
    digits = F.regexp_extract(name, r"\.([0-9]+)$", 1)
    return F.when(digits != "", digits).try_cast("long")


def after_start(spec: CaptureSpec, file: Column, start_pos: Column) -> Column:
    """At or after the start coordinates."""
    first = file_number(spec.from_binlog_file)
    if first is None:
        return (file == spec.from_binlog_file) & (start_pos >= spec.from_binlog_position)
    number = binlog_file_number(file)
    return (number > first) | ((number == first) & (start_pos >= spec.from_binlog_position))


def before_stop(spec: CaptureSpec, file: Column, log_pos: Column) -> Column:
    """Before the stop file's stop position; without a position the whole stop file is in."""
    if spec.to_binlog_file is None:
        return F.lit(True)
    last, number = file_number(spec.to_binlog_file), binlog_file_number(file)
    if last is None:
        inside = file == spec.to_binlog_file
        return inside if spec.to_binlog_position is None else inside & (log_pos < spec.to_binlog_position)
    if spec.to_binlog_position is None:
        return number <= last
    return (number < last) | ((number == last) & (log_pos < spec.to_binlog_position))


def in_range(events: DataFrame, spec: CaptureSpec) -> DataFrame:
    """Rows between the coordinates; needs binlog_file and log_pos, and start_pos if there is one.

    A stop position without a stop file ends the stream at the first row that
    reaches it, in order of file and position: one small aggregate finds it.
    """
    start = F.col("start_pos") if "start_pos" in events.columns else F.col("log_pos")
    out = events.filter(after_start(spec, F.col("binlog_file"), start) & before_stop(spec, F.col("binlog_file"), F.col("log_pos")))
    if spec.to_binlog_position is None or spec.to_binlog_file is not None:
        return out
    place = F.struct(binlog_file_number(F.col("binlog_file")).alias("n"), F.col("log_pos").alias("p"))
    first = out.filter(F.col("log_pos") >= spec.to_binlog_position).agg(F.min(place).alias("_stop"))
    return out.join(F.broadcast(first), F.col("_stop").isNull() | (place < F.col("_stop"))).drop("_stop")
