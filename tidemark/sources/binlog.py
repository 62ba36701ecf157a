"""The data source "binlog": log files as a table of events, in batch or as a stream.

Options: ``path`` (a folder or one file; a URI that pyarrow's file systems read,
or a local path), ``from_file``, ``from_pos``, ``to_file``, ``to_pos``,
``verify_checksum``, ``all_events`` and, for streams, ``max_events``. A file (of
a stream, what a batch takes of it) is one partition: its events are found by
hopping from header to header.
"""

from __future__ import annotations

import io
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from tidemark.schema import EVENT, FIRST_POSITION, FORMAT_DESCRIPTION, HEADER_BYTES, KEPT_EVENTS, MAGIC, ROTATE, ROW_EVENTS
from tidemark.shipping import ship
from tidemark.sources.wire import FormatDescription, WireError, strip_checksum
from tidemark.spec import file_number

BATCH_EVENTS, BATCH_BYTES = 4096, 16 << 20
READ_AHEAD = 1 << 18
_HEADER = struct.Struct("<IBIIIH")
_ARROW = pa.schema([("binlog_file", pa.string()), ("start_pos", pa.int64()), ("event_type", pa.int32()), ("timestamp", pa.int64()), ("server_id", pa.int64()), ("event_size", pa.int64()), ("log_pos", pa.int64()), ("flags", pa.int32()), ("data", pa.binary())])


class LogFile(InputPartition):
    def __init__(self, path: str, name: str) -> None:
        self.path, self.name = path, name


class LogStretch(LogFile):
    """What lies in a file between two places (to its end, if ``upto`` is None); ``form`` is where the format description in force stands."""

    def __init__(self, file: LogFile, at: int, form: int | None, upto: int | None) -> None:
        super().__init__(file.path, file.name)
        self.at, self.form, self.upto = at, form, upto


class Log:
    """The files of a log and the events in them."""

    def __init__(self, options: dict[str, str]) -> None:
        path = options["path"]
        self.fs, self.root = fs.FileSystem.from_uri(path) if re.match(r"[a-z][a-z0-9+.-]+://", path) else (fs.LocalFileSystem(), path)
        self.first = (options.get("from_file"), int(options.get("from_pos", FIRST_POSITION)))
        self.last = (options.get("to_file"), int(options["to_pos"]) if options.get("to_pos") else None)
        self.verify = options.get("verify_checksum", "false").lower() == "true"
        self.all = options.get("all_events", "false").lower() == "true"

    def files(self) -> list[LogFile]:
        """Numbered files in order of their numbers, within the range of files asked for."""
        info = self.fs.get_file_info(self.root)
        if info.type == fs.FileType.Directory:
            found = [(i.path, i.base_name) for i in self.fs.get_file_info(fs.FileSelector(self.root)) if i.is_file]
        elif info.type == fs.FileType.File:
            found = [(info.path, info.base_name)]
        else:
            raise FileNotFoundError(self.root)
        numbered = sorted((file_number(name), path, name) for path, name in found if file_number(name) is not None)
        low = file_number(self.first[0]) if self.first[0] else None
        high = file_number(self.last[0]) if self.last[0] else None
        return [LogFile(path, name) for n, path, name in numbered if (low is None or n >= low) and (high is None or n <= high)]

    def events(self, file: LogFile, at: int = FIRST_POSITION, form: int | None = None, upto: int | None = None, bodies: bool = True) -> Iterator[tuple]:
        """Events from a place on, as rows of EVENT; the file's format description is read whatever the place.

        If the place of the format description in force is given (``form``), nothing
        between it and the first event is read. Events that end beyond ``upto`` are
        left out. Without bodies rows hold no data, and those are not read.
        """
        begin = max(at, self.first[1]) if file.name == self.first[0] else at
        stop = self.last[1] if self.last[0] in (None, file.name) else None
        with self.fs.open_input_file(file.path) as raw:
            size, f = raw.size(), io.BufferedReader(raw, READ_AHEAD)
            if f.read(len(MAGIC)) != MAGIC:
                raise WireError(f"{file.name} is no binary log")
            checksum, pos = False, FIRST_POSITION
            if form is not None:
                pos = form
                f.seek(pos)
            while True:
                head = f.read(HEADER_BYTES)
                if len(head) < HEADER_BYTES:
                    return  # the end, or an event still being written
                timestamp, kind, server, length, _, flags = _HEADER.unpack(head)
                if length < HEADER_BYTES:
                    raise WireError(f"event of {length} bytes at {pos} in {file.name}")
                end = pos + length
                wanted = kind == FORMAT_DESCRIPTION or pos >= begin and (self.all or kind in KEPT_EVENTS)
                if pos >= begin and (stop is not None and end >= stop or upto is not None and end > upto):
                    return
                body = b""
                if wanted:
                    if bodies:
                        body = f.read(end - pos - HEADER_BYTES)
                    if len(body) < end - pos - HEADER_BYTES if bodies else end > size:
                        return
                    if kind == FORMAT_DESCRIPTION and bodies:
                        checksum = FormatDescription.read(body).checksum
                    # end positions are counted here: the header's field is 32 bits
                    yield (file.name, pos, kind, timestamp, server, length, end, flags, strip_checksum(body, checksum, head, self.verify) if bodies else None)
                if pos == form and end < at:
                    end = at
                if not (wanted and bodies) or end == at:
                    f.seek(end)
                pos = end


class BinlogReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def partitions(self) -> list[LogFile]:
        return Log(self.options).files()

    def read(self, partition: LogFile | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there was no file to read
            return
        yield from _batches(Log(self.options).events(partition))


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1])
        if len(held) >= BATCH_EVENTS or size >= BATCH_BYTES:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _ARROW)], schema=_ARROW)


def whole_statements(events: Iterator[tuple], most: int) -> list[tuple]:
    """Rows of EVENT up to the end of the statement that brings them to ``most``, or of the last one there is."""
    rows: list[tuple] = []
    ready = 0  # rows up to here end a statement
    for row in events:
        if row[2] not in ROW_EVENTS and (not rows or rows[-1][2] in ROW_EVENTS or rows[-1][2] == FORMAT_DESCRIPTION):
            ready = len(rows)
            if ready >= most:
                break
        rows.append(row)
    else:
        # at the log's end a rotation is whole, a table map may still lack its rows
        ready = len(rows) if not rows or rows[-1][2] in ROW_EVENTS or rows[-1][2] == ROTATE else ready
    return rows[:ready]


class BinlogStream(DataSourceStreamReader):
    """Offsets are a file, a position, always between statements, and where the file's format description stands.

    A batch never ends between a table map and its rows, so every batch holds
    the table maps that its row events need. The driver reads headers only, to find
    a batch's end; tasks read the events, one for each file.
    """

    def __init__(self, options: dict[str, str]) -> None:
        self.options = options
        self.most = int(options.get("max_events", 10_000))
        self.at: dict | None = None  # the end of the last batch planned
        self.known: list[LogFile] = []

    def initialOffset(self) -> dict:
        log = Log(self.options)
        files = log.files()
        return {"file": log.first[0] or (files[0].name if files else ""), "pos": log.first[1]}

    def _walk(self, start: dict) -> Iterator[tuple]:
        """Headers from the offset on, as rows without data, each with the place of the format description in force.

        Files are listed again only when those known are through, as a log may have
        very many. Then the last of them is read on first: it may have grown before
        the next began.
        """
        log, place, listed = Log(self.options), start, not self.known
        self.known = self.known or log.files()
        while True:
            first = file_number(place["file"]) if place["file"] else None
            self.known = [f for f in self.known if first is None or file_number(f.name) >= first]
            for file in self.known:
                at, form = (place["pos"], place.get("format")) if file_number(file.name) == first else (FIRST_POSITION, None)
                for row in log.events(file, at, form, bodies=False):
                    if row[2] == FORMAT_DESCRIPTION:
                        form = row[1]
                    if row[1] >= at:
                        yield (*row[:8], form)
                        place = self._offset(row, form)
            if listed:
                return
            was, self.known, listed = self.known, log.files(), True
            if len(was) == sum(first is None or file_number(f.name) >= first for f in self.known):
                return

    @staticmethod
    def _offset(row: tuple, form: int | None) -> dict:
        """The place after an event."""
        return {"file": row[0], "pos": row[6]} | ({} if form is None else {"format": form})

    def latestOffset(self) -> dict:
        if self.at is None:
            self.at = self.initialOffset()
        rows = whole_statements(self._walk(self.at), self.most)
        if rows:
            self.at = self._offset(rows[-1], rows[-1][8])
        return self.at

    def partitions(self, start: dict, end: dict) -> list[LogStretch]:
        if self.at is None:  # the query goes on from its checkpoint
            self.at = end
        if start == end:
            return []
        first, last = file_number(start["file"]) if start["file"] else None, file_number(end["file"])
        files = self.known
        if not files or first is None or not file_number(files[0].name) <= first <= last <= file_number(files[-1].name):
            # a batch of before the checkpoint
            files = Log(self.options).files()
        out = []
        for file in files:
            number = file_number(file.name)
            if (first is None or number >= first) and number <= last:
                at, form = (start["pos"], start.get("format")) if number == first else (FIRST_POSITION, None)
                upto = end["pos"] if number == last else None
                if upto is None or at < upto:
                    out.append(LogStretch(file, at, form, upto))
        return out

    def read(self, partition: LogStretch) -> Iterator[pa.RecordBatch]:
        rows = Log(self.options).events(partition, partition.at, partition.form, partition.upto)
        yield from _batches(row for row in rows if row[1] >= partition.at)

    def commit(self, end: dict) -> None:
        """Files are kept by the server; nothing to release."""


class BinlogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "binlog"

    def schema(self) -> StructType:
        return EVENT

    def reader(self, schema: StructType) -> BinlogReader:
        return BinlogReader(dict(self.options))

    def streamReader(self, schema: StructType) -> BinlogStream:
        return BinlogStream(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make format("binlog") known to the session."""
    ship(spark)
    spark.dataSource.register(BinlogSource)
