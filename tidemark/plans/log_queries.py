"""Queries that go through whole log files, and those of single decoders, with the SQL to hold them against.

The logs are made from the orders, a file for 1,000 keys: a format description, a
table map and one row event per order, a rotation. The kind of event goes by key %
6 (the three kinds, in V2 and V1 framing); columns are of the types that the
other queries lack; c14 is null for every 7th key, and absent from V2 updates of every 11th.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import ints, temporal
from tidemark.operators import bind, decode, envelope, filters, sinks
from tidemark.operators.rows import display
from tidemark.plans.capture import read_events, run
from tidemark.plans.queries import ORACLE_SQL, QUERIES, _scratch, query
from tidemark.plans.synthetic import place, table
from tidemark.schema import DELETE_ROWS, DELETE_ROWS_V1, TABLE_MAP, UPDATE_ROWS, UPDATE_ROWS_V1, WRITE_ROWS, WRITE_ROWS_V1
from tidemark.shipping import ship
from tidemark.spec import CaptureSpec, Pattern, SpecError
from tidemark.streaming.follow import catch_up

_KINDS = (WRITE_ROWS, UPDATE_ROWS, DELETE_ROWS, WRITE_ROWS_V1, UPDATE_ROWS_V1, DELETE_ROWS_V1)
#: LONGLONG, INT24, TINY, YEAR, BIT(9), ENUM, SET, STRING, TIMESTAMP, DATETIME, TIME, FLOAT, DATE, BLOB, VARCHAR.
_COLUMNS = [(8, 0), (9, 0), (1, 0), (13, 0), (16, 1 << 8 | 1), (247, 247 << 8 | 1), (248, 248 << 8 | 1), (254, 0xFE << 8 | 10), (7, 0), (12, 0), (11, 0), (4, 4), (10, 0), (252, 2), (15, 60)]


def _values(key: int, customer: int, status: str, priority: str, parts: tuple[int, ...], seconds: int) -> list[bytes | None]:
    import struct

    from tidemark.sources import encode as enc

    year, month, day, hour, minute, second = parts
    number = ((year * 100 + month) * 100 + day) * 1_000_000 + (hour * 100 + minute) * 100 + second
    span = (key % 1600 - 800) * 10_000 + (key % 60 * 100 + key % 50) * (1 if key % 1600 >= 800 else -1)
    return [
        key.to_bytes(8, "little"), (customer - 1000).to_bytes(3, "little", signed=True), (key % 200 - 100).to_bytes(1, "little", signed=True), bytes([year - 1900]),
        (key % 512).to_bytes(2, "big"), bytes([key % 5 + 1]), bytes([1 << key % 8]), enc.varchar(status, 10), seconds.to_bytes(4, "little"), number.to_bytes(8, "little"),
        span.to_bytes(3, "little", signed=True), struct.pack("<f", key % 1000 / 4), (year << 9 | month << 5 | day).to_bytes(3, "little"), enc.blob(priority.encode(), 2), None if key % 7 == 0 else enc.varchar(priority, 60),
    ]


def write_logs(spark: SparkSession, sf_dir: str, folder: str, faults: bool = False) -> list[str]:
    """Write the logs under a shared folder, a task per file; returns their names.

    With faults, every 13th order's event is cut short, and every 17th's has an id without a table map.
    """
    ship(spark)
    orders = place(table(spark, sf_dir, "orders"), F.col("o_orderkey"))
    when = [F.date_part(F.lit(p), "o_orderdate").cast("int") for p in ("year", "month", "day", "hour", "minute", "second")]
    row = F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.array(*when).alias("parts"), F.unix_timestamp("o_orderdate").alias("seconds"))
    # a file holds 1,000 orders at most
    grouped = orders.groupBy("binlog_file").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    last_file = orders.agg(F.max("binlog_file")).first()[0]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        from pyarrow import fs

        from tidemark.sources import encode as enc

        store, root = fs.FileSystem.from_uri(folder) if re.match(r"[a-z][a-z0-9+.-]+:/", folder) else (fs.LocalFileSystem(), folder)
        store.create_dir(root, recursive=True)
        for batch in batches:
            for name, rows in zip(*(batch.column(c).to_pylist() for c in ("binlog_file", "rows"))):
                events = []
                for r in rows:
                    key = r["o_orderkey"]
                    kind = _KINDS[key % 6]
                    values = _values(key, r["o_custkey"], r["o_orderstatus"], r["o_orderpriority"], tuple(r["parts"]), r["seconds"])
                    present = [True] * 14 + [not (kind == UPDATE_ROWS and key % 11 == 0)]
                    images = [enc.image(values, present)]
                    if kind in (UPDATE_ROWS, UPDATE_ROWS_V1):
                        old = list(values)
                        old[1] = (r["o_custkey"] - 1001).to_bytes(3, "little", signed=True)
                        images.insert(0, enc.image(old, present))
                    body = enc.rows(kind, 99 if faults and key % 17 == 0 else 7, 15, images, present)
                    events += [(TABLE_MAP, enc.table_map(7, "tpch", "orders" if key % 5 else "fifths", _COLUMNS), r["seconds"], 1 + key % 3), (kind, body[:-3] if faults and key % 13 == 0 else body, r["seconds"], 1 + key % 3)]
                following = None if name == last_file else f"{name[:-6]}{int(name[-6:]) + 1:06d}"
                with store.open_output_stream(f"{root}/{name}") as out:
                    out.write(enc.log_file(events, int(name[-6:]) % 2 == 0, following))
                yield pa.RecordBatch.from_arrays([pa.array([name])], names=["name"])

    return sorted(r.name for r in grouped.mapInArrow(write, "name string").collect())


def _logs(spark: SparkSession, sf_dir: str, faults: bool = False) -> str:
    folder = _scratch(spark, "logs")
    write_logs(spark, sf_dir, folder, faults)
    return folder


_FIRST = CaptureSpec(from_binlog_file="binlog.000001")

_LOGS_SQL = """
WITH o AS (
  SELECT o_orderkey AS k, o_custkey AS cust, o_orderstatus AS status, o_orderpriority AS priority, o_orderdate AS d, printf('binlog.%06d', 1 + o_orderkey // 1000) AS binlog_file,
         CASE o_orderkey % 3 WHEN 0 THEN 'INSERT' WHEN 1 THEN 'UPDATE' ELSE 'DELETE' END AS dml_type, CASE WHEN o_orderkey % 5 = 0 THEN 'fifths' ELSE 'orders' END AS table_name,
         o_orderkey % 6 AS kind, o_orderkey % 1600 - 800 AS h,
         o_orderkey % 7 = 0 OR (o_orderkey % 6 = 1 AND o_orderkey % 11 = 0) AS gone
  FROM orders),
v AS (
  SELECT *, CAST(k % 200 - 100 AS VARCHAR) AS c2, CAST(year(d) AS VARCHAR) AS c3, '0x' || printf('%04x', k % 512) AS c4, CAST(k % 5 + 1 AS VARCHAR) AS c5, CAST(1 << CAST(k % 8 AS INTEGER) AS VARCHAR) AS c6,
         CASE WHEN h < 0 THEN '-' ELSE '' END || printf('%02d:%02d:%02d', abs(h), k % 60, k % 50) AS c10, regexp_replace(CAST(k % 1000 / 4.0 AS VARCHAR), '\\.0$', '') AS c11, '0x' || lower(hex(priority)) AS c13
  FROM o)
"""


def _image_sql(less: int) -> str:
    return f"""'{{"c0":' || k || ',"c1":' || (cust - 1000 - {less}) || ',"c2":' || c2 || ',"c3":' || c3 || ',"c4":"' || c4 || '","c5":' || c5 || ',"c6":' || c6 || ',"c7":"' || status || '","c8":"' || strftime(d, '%Y-%m-%dT%H:%M:%SZ')
      || '","c9":"' || strftime(d, '%Y-%m-%d %H:%M:%S') || '","c10":"' || c10 || '","c11":' || c11 || ',"c12":"' || strftime(d, '%Y-%m-%d') || ' 00:00:00","c13":"' || c13 || '","c14":' || CASE WHEN gone THEN 'null' ELSE '"' || priority || '"' END || '}}'"""


_ROWS_SQL = _LOGS_SQL + f"""
SELECT binlog_file, 'tpch' AS database, table_name, dml_type, CASE WHEN dml_type <> 'INSERT' THEN {_image_sql(1)} END AS before_update, CASE WHEN dml_type <> 'DELETE' THEN {_image_sql(0)} END AS after_values,
       CASE WHEN dml_type = 'DELETE' THEN {_image_sql(0)} END AS before_delete
FROM v
"""
_OUT_SQL = "SELECT binlog_file, database, table_name, dml_type, CASE dml_type WHEN 'UPDATE' THEN before_update WHEN 'DELETE' THEN before_delete END AS before_values, after_values FROM (" + _ROWS_SQL + ")"


@query(_OUT_SQL)
def log_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log files written and read by the data source: both framings, updates, deletes, nulls, absent columns, and all the other types."""
    rows = decode.decode(read_events(spark, _logs(spark, sf_dir), _FIRST), _FIRST, ordered=True)
    return rows.select("binlog_file", "database", "table_name", "dml_type", "before_values", "after_values")


@query(_OUT_SQL)
def log_file_rows_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the as-of join of row events with table maps, then expansion."""
    from tidemark.operators.rows import expand

    rows = expand(bind.bind(read_events(spark, _logs(spark, sf_dir), _FIRST)))
    return rows.select("binlog_file", "database", "table_name", "dml_type", "before_values", "after_values")


@query(_OUT_SQL.replace("FROM (" + _ROWS_SQL, "FROM (SELECT * FROM (" + _ROWS_SQL + ") WHERE table_name = 'orders' AND binlog_file >= 'binlog.000002'"))
def log_file_rows_chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A capture with table rules and a start file."""
    spec = CaptureSpec(from_binlog_file="binlog.000002", include=("tpch.*",), exclude=("tpch.fifths",))
    rows = decode.decode(read_events(spark, _logs(spark, sf_dir), spec), spec, ordered=True)
    return rows.select("binlog_file", "database", "table_name", "dml_type", "before_values", "after_values")


@query(_LOGS_SQL + """
, n AS (
  SELECT binlog_file, 'TABLE_MAP_EVENT' AS name FROM o
  UNION ALL SELECT binlog_file, CASE kind % 3 WHEN 0 THEN 'WRITE' WHEN 1 THEN 'UPDATE' ELSE 'DELETE' END || '_ROWS_EVENT' || CASE WHEN kind > 2 THEN '_V1' ELSE '' END FROM o
  UNION ALL SELECT DISTINCT binlog_file, 'FORMAT_DESCRIPTION_EVENT' FROM o
  UNION ALL SELECT DISTINCT binlog_file, 'ROTATE_EVENT' FROM o WHERE binlog_file <> (SELECT max(binlog_file) FROM o))
SELECT binlog_file, name, count(*) AS n FROM n GROUP BY 1, 2
""")
def log_file_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_events(spark, _logs(spark, sf_dir))
    return events.groupBy("binlog_file", envelope.event_name(F.col("event_type")).alias("name")).agg(F.count("*").alias("n"))


@query(_LOGS_SQL + """
SELECT DISTINCT binlog_file, CAST(4 AS BIGINT) AS next_position, printf('binlog.%06d', 2 + k // 1000) AS next_file, true AS artificial FROM o WHERE binlog_file <> (SELECT max(binlog_file) FROM o)
""")
def log_rotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rotated = bind.rotations(read_events(spark, _logs(spark, sf_dir)))
    return rotated.withColumn("artificial", envelope.is_artificial_rotate(F.col("next_position")))


def _shown_sql(less: int) -> str:
    return f"""k || ', ' || (cust - 1000 - {less}) || ', ' || c2 || ', ' || c3 || ', ' || c4 || ', ' || c5 || ', ' || c6 || ', ''' || status || ''', ' || strftime(d, '%Y-%m-%d %H:%M:%S') || ', ' || CASE WHEN strftime(d, '%H%M%S') = '000000' THEN strftime(d, '%Y-%m-%d') ELSE strftime(d, '%Y-%m-%d %H:%M:%S') END
      || ', ' || c10 || ', ' || c11 || ', ' || strftime(d, '%Y-%m-%d') || ', ' || c13 || ', ' || CASE WHEN gone THEN 'NULL' ELSE '''' || priority || '''' END"""


@query(_LOGS_SQL + f"""
SELECT '[' || dml_type || '] tpch.' || table_name AS head,
       'LONGLONG, INT24, TINY, YEAR, BIT, ENUM, SET, STRING, TIMESTAMP, DATETIME, TIME, FLOAT, DATE, BLOB, VARCHAR' || CASE dml_type WHEN 'UPDATE' THEN chr(10) || '  before: ' || {_shown_sql(1)} WHEN 'DELETE' THEN chr(10) || '  before: ' || {_shown_sql(0)} ELSE '' END
       || CASE WHEN dml_type <> 'DELETE' THEN chr(10) || '  after: ' || {_shown_sql(0)} ELSE '' END AS shown
FROM v
""")
def log_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text sink's blocks: head, types and values."""
    blocks = display(bind.bind(read_events(spark, _logs(spark, sf_dir), _FIRST)))
    return blocks.select(F.substring_index("value", "\n", 1).alias("head"), F.regexp_extract("value", r"(?s)\n  columns: (.*)$", 1).alias("shown"))


@query(_LOGS_SQL + """
SELECT CASE WHEN k % 17 = 0 THEN 'no table map' WHEN k % 5 = 0 THEN 'table left out' WHEN k % 13 = 0 THEN 'unreadable' END AS reason, count(*) AS events FROM o WHERE k % 17 = 0 OR k % 5 = 0 OR k % 13 = 0 GROUP BY 1
""")
def log_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row events that are cut short, without a table map, or left out by the rules."""
    spec = CaptureSpec(from_binlog_file="binlog.000001", exclude=("tpch.fifths",))
    rows = decode.decode(read_events(spark, _logs(spark, sf_dir, True), spec), spec, ordered=True, report=True)
    reason = F.when(F.col("_error").isin(decode.UNBOUND, decode.FILTERED), F.col("_error")).otherwise("unreadable")
    return rows.filter("_error IS NOT NULL").groupBy(reason.alias("reason")).agg(F.count("*").alias("events"))


@query(_LOGS_SQL + """
, e AS (SELECT count(*) AS n, count(DISTINCT binlog_file) AS files FROM o)
SELECT CAST(2 * n + 2 * files - 1 AS BIGINT) AS events_read, (SELECT count(*) FROM o WHERE k % 17 <> 0 AND k % 5 <> 0 AND k % 13 <> 0) AS rows_processed, (SELECT count(*) FROM o WHERE k % 17 <> 0 AND k % 5 <> 0 AND k % 13 = 0) AS rows_quarantined,
       (SELECT count(*) FROM o WHERE k % 17 = 0) AS events_unbound, (SELECT count(*) FROM o WHERE k % 17 <> 0 AND k % 5 = 0) AS tables_filtered,
       (SELECT count(DISTINCT binlog_file) FROM o WHERE k % 17 <> 0 AND k % 5 <> 0 AND k % 13 <> 0) AS files_written, (SELECT count(*) FROM o WHERE k % 17 = 0 OR (k % 5 <> 0 AND k % 13 = 0)) AS set_aside
FROM e
""")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run in Parquet mode: its counters, and the rows of _quarantine."""
    out = _scratch(spark, "capture")
    spec = CaptureSpec(from_binlog_file="binlog.000001", exclude=("tpch.fifths",), output_mode="parquet", parquet_output_dir=out, log_level="err")
    counts = run(spark, _logs(spark, sf_dir, True), spec)
    names = ("events_read", "rows_processed", "rows_quarantined", "events_unbound", "tables_filtered", "files_written")
    aside = spark.read.parquet(f"{out}/_quarantine").agg(F.count("*").alias("set_aside"))
    return aside.select(*(F.lit(int(counts[n])).cast("long").alias(n) for n in names), "set_aside")


@query(_LOGS_SQL + "SELECT binlog_file, table_name, dml_type, count(*) AS rows, count(DISTINCT k) AS distinct_rows FROM o GROUP BY 1, 2, 3")
def stream_catch_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logs followed as a stream, in batches that end between statements; a second catching up adds nothing."""
    logs, out, state = _logs(spark, sf_dir), _scratch(spark, "stream"), _scratch(spark, "state")
    for _ in range(2):
        catch_up(spark, logs, _FIRST, out, state, max_events=20_000)
    image = F.coalesce("after_values", "before_values")
    return spark.read.parquet(out).groupBy(F.col("_file").alias("binlog_file"), "table_name", "dml_type").agg(F.count("*").alias("rows"), F.count_distinct(F.get_json_object(image, "$.c0")).alias("distinct_rows"))


# --- decoders of one value ----------------------------------------------------


@query("SELECT event_id, epoch_us(ts) // 1000000 AS timestamp, CAST(30 + event_id % 3 AS INTEGER) AS event_type, user_id AS server_id, CAST(100 + event_id % 1000 AS BIGINT) AS event_size, CAST(event_id % 4000000000 AS BIGINT) AS log_pos, CAST(event_id % 65536 AS INTEGER) AS flags FROM events WHERE event_id % 10 <> 0")
def packet_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers of packets; packets too short for one are left out."""
    key = F.col("event_id")
    packet = F.concat(ints.to_le(F.unix_timestamp("ts"), 4), ints.to_le(F.pmod(key, F.lit(3)) + 30, 1), ints.to_le(F.col("user_id"), 4), ints.to_le(F.pmod(key, F.lit(1000)) + 100, 4), ints.to_le(F.pmod(key, F.lit(4_000_000_000)), 4), ints.to_le(F.pmod(key, F.lit(65536)), 2))
    short = F.when(F.pmod(key, F.lit(10)) == 0, F.substring(packet, 1, 18)).otherwise(packet)
    return table(spark, sf_dir, "events").withColumn("packet", short).filter(filters.whole_packet(F.col("packet"))).select("event_id", bind.header(F.col("packet")).alias("h")).select("event_id", "h.*")


_WIDE = "l_orderkey * l_partkey * l_linenumber"


@query(f"SELECT l_orderkey, l_linenumber, CAST({_WIDE} AS BIGINT) AS value, CASE WHEN {_WIDE} < 251 THEN 1 WHEN {_WIDE} < 65536 THEN 3 WHEN {_WIDE} < 16777216 THEN 4 ELSE 9 END AS width FROM lineitem")
def lenenc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.expr(f"cast({_WIDE} as bigint)")
    mark = lambda m, width: F.concat(F.unhex(F.lit(m)), ints.to_le(v, width))
    data = F.when(v < 251, ints.to_le(v, 1)).when(v < 1 << 16, mark("FC", 2)).when(v < 1 << 24, mark("FD", 3)).otherwise(mark("FE", 8))
    return table(spark, sf_dir, "lineitem").withColumn("data", data).select("l_orderkey", "l_linenumber", ints.lenenc_int(F.col("data")).alias("i")).select("l_orderkey", "l_linenumber", "i.*")


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, epoch_us(ts) // 1000000 * 1000000 AS micros, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS instant, CAST(year(ts) AS BIGINT) AS y,
       CASE WHEN event_id % 1600 < 800 THEN '-' ELSE '' END || printf('%02d:%02d:%02d', abs(event_id % 1600 - 800), event_id % 60, event_id % 50) AS span
FROM events WHERE event_id % 1600 <> 800
""")
def legacy_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DATETIME, TIMESTAMP, YEAR and TIME as older servers store them."""
    key = F.col("event_id")
    stamp = ints.to_le(F.date_format("ts", "yyyyMMddHHmmss").cast("long"), 8)
    hours = F.pmod(key, F.lit(1600)) - 800
    clock = F.abs(hours) * 10_000 + F.pmod(key, F.lit(60)) * 100 + F.pmod(key, F.lit(50))
    micros = temporal.decode_timestamp(ints.to_le(F.unix_timestamp("ts"), 4))
    return table(spark, sf_dir, "events").filter("event_id % 1600 <> 800").select(
        "event_id", temporal.decode_datetime_legacy(stamp).alias("stamp"), micros.alias("micros"), temporal.timestamp_text(micros).alias("instant"), temporal.decode_year(ints.to_le(F.year("ts") - 1900, 1)).cast("long").alias("y"),
        temporal.duration_text(temporal.decode_time(ints.to_le(F.when(hours < 0, -clock).otherwise(clock), 3))).alias("span"),
    )


@query("""
WITH m AS (SELECT event_id, event_id % 65536 AS meta, (event_id % 65536) // 256 AS high, event_id % 256 AS low FROM events)
SELECT event_id, CAST(CASE WHEN high & 48 <> 48 THEN high | 48 ELSE high END AS BIGINT) AS type, CAST(CASE WHEN high & 48 <> 48 THEN low | (xor(high & 48, 48) << 4) ELSE low END AS BIGINT) AS length,
       CAST(high + CASE WHEN low > 0 THEN 1 ELSE 0 END AS BIGINT) AS bytes, (event_id >> 3) & 1 = 1 AS third, (event_id >> 9) & 1 = 1 AS ninth
FROM m
""")
def column_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unfolded STRING metadata, bytes of BIT columns, bits of bitmaps."""
    meta, bits = F.pmod(F.col("event_id"), F.lit(65536)), ints.to_le(F.col("event_id"), 3)
    s = ints.string_meta(meta)
    return table(spark, sf_dir, "events").select("event_id", s["type"].cast("long").alias("type"), s["length"].cast("long").alias("length"), ints.bit_bytes(meta).cast("long").alias("bytes"), ints.bit_is_set(bits, 3).alias("third"), ints.bit_is_set(bits, 9).alias("ninth"))


@query("""
SELECT '[EVENT]' || chr(10) || '  type: ' || CASE event_id % 3 WHEN 0 THEN 'ROTATE_EVENT (4)' WHEN 1 THEN 'TABLE_MAP_EVENT (19)' ELSE 'UNKNOWN_EVENT (99)' END || chr(10) || '  timestamp: ' || epoch_us(ts) // 1000000 || chr(10) || '  server_id: ' || user_id
       || chr(10) || '  event_size: ' || event_id || chr(10) || '  log_pos: ' || (event_id + 5) || chr(10) || '  flags: 0' || chr(10) || '  data: ' || strlen(props) || ' bytes' AS value
FROM events
""")
def event_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of any kind as the text sink writes them."""
    kind = F.element_at(F.array(F.lit(4), F.lit(19), F.lit(99)), (F.pmod("event_id", F.lit(3)) + 1).cast("int"))
    events = table(spark, sf_dir, "events").select(kind.alias("event_type"), F.unix_timestamp("ts").alias("timestamp"), F.col("user_id").alias("server_id"), F.col("event_id").alias("event_size"), (F.col("event_id") + 5).alias("log_pos"), F.lit(0).alias("flags"), F.col("props").cast("binary").alias("data"))
    return sinks.event_text(events)


@query("""
WITH n AS (SELECT replace(n_name, ' ', '_') AS s FROM nation)
SELECT s || '.t' AS pattern, true AS valid, 0 AS level FROM n UNION ALL SELECT '*.' || s, true, 1 FROM n UNION ALL SELECT s || '.*', true, 2 FROM n
UNION ALL SELECT s, false, NULL FROM n UNION ALL SELECT s || '.', false, NULL FROM n UNION ALL SELECT '.' || s, false, NULL FROM n UNION ALL SELECT s || '.a.b', false, NULL FROM n UNION ALL SELECT s || '*.t', false, NULL FROM n UNION ALL SELECT '*.*', false, NULL
""")
def pattern_parser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which texts are patterns, and how specific: a few for each nation's name."""
    out = []
    names = [r.n_name.replace(" ", "_") for r in table(spark, sf_dir, "nation").select("n_name").collect()]
    for text in [f.format(n) for n in names for f in ("{}.t", "*.{}", "{}.*", "{}", "{}.", ".{}", "{}.a.b", "{}*.t")] + ["*.*"]:
        try:
            out.append((text, True, Pattern.parse(text).level))
        except SpecError:
            out.append((text, False, None))
    return spark.createDataFrame(out, "pattern string, valid boolean, level int")


__all__ = ["ORACLE_SQL", "QUERIES", "write_logs"]
