"""Events to change rows in one pass over each log file.

Table maps and format descriptions travel in the decoder's state, so a file's
payload is read once and shuffled at most once; range rules are applied before the
decoder and table rules in it, before a row image is touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.operators.filters import after_start, before_stop, in_range
from tidemark.operators.rows import OUT_ROWS, rows_batch
from tidemark.schema import CHANGES, DML, FORMAT_DESCRIPTION, ROW_EVENTS, TABLE_MAP
from tidemark.shipping import ship
from tidemark.sources.wire import FormatDescription, WireError, read_rows_json, read_table_map
from tidemark.spec import CaptureSpec, TableRules

#: What ``_error`` says of row events that are not decoded.
UNBOUND, FILTERED = "no table map", "table left out"
#: Events that hold what row events need.
_FRAME = (FORMAT_DESCRIPTION, TABLE_MAP)


def within(events: DataFrame, spec: CaptureSpec | None) -> DataFrame:
    """Row events of the spec's range, and all events that later ones may need."""
    kind, file = F.col("event_type"), F.col("binlog_file")
    wanted = events.filter(kind.isin(*ROW_EVENTS, *_FRAME))
    if spec is None:
        return wanted
    if spec.to_binlog_position is not None and spec.to_binlog_file is None:
        # the stop is the first event of any file that reaches the position
        return in_range(wanted.filter(kind.isin(*ROW_EVENTS)), spec).unionByName(wanted.filter(kind.isin(*_FRAME)))
    return wanted.filter(kind.isin(*_FRAME) | after_start(spec, file, F.col("start_pos")) & before_stop(spec, file, F.col("log_pos")))


def decode(events: DataFrame, spec: CaptureSpec | None = None, unsigned: dict[str, tuple[int, ...]] | None = None, ordered: bool = False, report: bool = False) -> DataFrame:
    """Change rows of events, numbered from 1 within each event.

    With ``ordered`` each file is in one partition in order of position, as the
    data sources give it; else one shuffle by file brings that about. An event
    that can't be read to its end yields the rows before the fault and then one
    with ``_error`` set. With ``report`` a row event without a table map, or of a
    table that the rules leave out, yields one such row too; else none.
    ``unsigned`` names columns (``{"db.table": (0, 2)}``) whose integers are
    unsigned, which the log does not say. Null data counts as empty; an empty
    table gives no rows.
    """
    ship(events.sparkSession)
    wide = {k: frozenset(v) for k, v in (unsigned or {}).items()}
    rules = spec.rules if spec else TableRules()
    work = within(events, spec).select("binlog_file", "start_pos", "event_type", "timestamp", "server_id", "log_pos", F.coalesce("data", F.lit(b"")).alias("data"))
    if not ordered:
        work = work.repartition("binlog_file").sortWithinPartitions("binlog_file", "start_pos")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        file, lengths, tables = None, (), {}
        for batch in batches:
            for name, kind, at, server, end, body in zip(*(batch.column(c).to_pylist() for c in ("binlog_file", "event_type", "timestamp", "server_id", "log_pos", "data"))):
                if name != file:
                    file, lengths, tables = name, (), {}
                try:
                    if kind == FORMAT_DESCRIPTION:
                        lengths = FormatDescription.read(body).post_header_len
                        continue
                    if kind == TABLE_MAP:
                        m = read_table_map(body)
                        tables[m.table_id] = (m, rules.admits(m.database, m.table_name), wide.get(f"{m.database}.{m.table_name}", frozenset()))
                        continue
                except WireError:
                    if kind == TABLE_MAP:
                        tables.pop(int.from_bytes(body[:6], "little"), None)
                    continue
                base = (name, at, server - (1 << 32) if server >= 1 << 31 else server, end)
                found = tables.get(int.from_bytes(body[:6], "little"))
                if found is None or not found[1]:
                    if report:
                        of = (None, None) if found is None else (found[0].database, found[0].table_name)
                        held.append((*base, 1, *of, DML[kind], None, None, UNBOUND if found is None else FILTERED))
                    continue
                m, _, wide_here = found
                tail, index = (m.database, m.table_name), 0
                # without a format description the event's code tells
                two = lengths[kind - 1] == 10 if len(lengths) >= kind else kind >= 30
                try:
                    for index, dml, before, after in read_rows_json(kind, body, m.types, m.metas, two, wide_here):
                        held.append((*base, index, *tail, dml, before, after, None))
                        if len(held) >= OUT_ROWS:
                            yield rows_batch(held)
                            held = []
                except WireError as fault:
                    held.append((*base, index + 1, *tail, DML[kind], None, None, str(fault)))
            if len(held) >= OUT_ROWS:
                yield rows_batch(held)
                held = []
        if held:
            yield rows_batch(held)

    return work.mapInArrow(read, CHANGES)
