"""Row events to change rows: one event becomes as many rows as it holds."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.schema import CHANGES, TYPE_NAMES
from tidemark.shipping import ship
from tidemark.sources.wire import WireError, read_rows, read_rows_json, value_display

_OUT = pa.schema([("binlog_file", pa.string()), ("timestamp", pa.int64()), ("server_id", pa.int32()), ("log_pos", pa.int64()), ("event_row_index", pa.int64()), ("database", pa.string()), ("table_name", pa.string()), ("dml_type", pa.string()), ("before_values", pa.string()), ("after_values", pa.string()), ("_error", pa.string())])
#: Rows sent back at once; an event of many rows does not pile up.
OUT_ROWS = 8192


def expand(bound: DataFrame, unsigned: dict[str, tuple[int, ...]] | None = None) -> DataFrame:
    """Change rows of bound row events, numbered from 1 within the event.

    An event that can't be read to its end yields the rows before the fault and
    then one row with ``_error`` set, numbered after them and without images.
    ``unsigned`` names columns (``{"db.table": (0, 2)}``) whose integers are
    unsigned, which the log does not say.
    """
    ship(bound.sparkSession)
    wide = {k: frozenset(v) for k, v in (unsigned or {}).items()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for e in batch.to_pylist():
                t = e["table"]
                types, metas = tuple(c["type"] for c in t["columns"]), tuple(c["meta"] for c in t["columns"])
                server = e["server_id"] - (1 << 32) if e["server_id"] >= 1 << 31 else e["server_id"]
                base, tail = (e["binlog_file"], e["timestamp"], server, e["log_pos"]), (t["database"], t["table_name"])
                index, dml = 0, None
                try:
                    for index, dml, before, after in read_rows_json(e["event_type"], e["data"], types, metas, e["version_two"], wide.get(f"{tail[0]}.{tail[1]}", frozenset())):
                        held.append((*base, index, *tail, dml, before, after, None))
                        if len(held) >= OUT_ROWS:
                            yield rows_batch(held)
                            held = []
                except WireError as fault:
                    held.append((*base, index + 1, *tail, dml or e["dml_type"], None, None, str(fault)))
        if held:
            yield rows_batch(held)

    from tidemark.operators.envelope import dml_type

    known = bound.filter(F.col("table").isNotNull()).withColumn("dml_type", dml_type(F.col("event_type")))
    return known.select("binlog_file", "timestamp", "server_id", "log_pos", "event_type", "data", "table", "version_two", "dml_type").mapInArrow(read, CHANGES)


def display(bound: DataFrame) -> DataFrame:
    """The text sink's blocks: binlog_file, log_pos, event_row_index, and ``value`` with a row's types and values.

    A fault in an event ends its rows with a block that says so.
    """
    ship(bound.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for e in batch.to_pylist():
                t = e["table"]
                types, metas = tuple(c["type"] for c in t["columns"]), tuple(c["meta"] for c in t["columns"])
                name, index = f"{t['database']}.{t['table_name']}", 0
                where = f"  at: {e['binlog_file']}:{e['log_pos']} row "
                rest = f"  server: {e['server_id']}  time: {e['timestamp']}\n  columns: {', '.join(TYPE_NAMES.get(k, 'UNKNOWN') for k in types)}"
                try:
                    for row in read_rows(e["event_type"], e["data"], types, metas, e["version_two"]):
                        index = row.index
                        images = "".join(f"\n  {label}: {', '.join(map(value_display, values))}" for label, values in (("before", row.before), ("after", row.after)) if values is not None)
                        out.append((e["binlog_file"], e["log_pos"], index, f"[{row.dml}] {name}\n{where}{index}\n{rest}{images}"))
                except WireError as fault:
                    out.append((e["binlog_file"], e["log_pos"], index + 1, f"[UNREADABLE] {name}\n{where}{index + 1}\n  {fault}"))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["binlog_file", "log_pos", "event_row_index", "value"])

    known = bound.filter(F.col("table").isNotNull())
    return known.select("binlog_file", "timestamp", "server_id", "log_pos", "event_type", "data", "table", "version_two").mapInArrow(read, "binlog_file string, log_pos long, event_row_index long, value string")


def rows_batch(rows: list[tuple]) -> pa.RecordBatch:
    """Tuples in the order of CHANGES as one batch."""
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _OUT)], schema=_OUT)
