"""Queries on the driver's tables, one or more per operator, and the SQL to hold them against."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions import decimal, ints, temporal, text
from tidemark.operators import analytics, bind, decode, envelope, filters, metrics, sinks
from tidemark.plans.synthetic import CHANGES_SQL, order_changes, place, table
from tidemark.schema import FORMAT_DESCRIPTION, TABLE_MAP, TYPE_CODES, UPDATE_ROWS, WRITE_ROWS
from tidemark.shipping import ship
from tidemark.spec import CaptureSpec, TableRules

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# --- envelope ---------------------------------------------------------------


@query(CHANGES_SQL + "SELECT * EXCLUDE (binlog_file) FROM ch")
def envelope_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projection of orders to change rows with JSON images."""
    return envelope.to_envelope(order_changes(spark, sf_dir))


@query(CHANGES_SQL + "SELECT dml_type, count(*) AS changes, count(before_values) AS with_before, count(after_values) AS with_after FROM ch GROUP BY 1")
def image_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_changes(spark, sf_dir).groupBy("dml_type").agg(F.count("*").alias("changes"), F.count("before_values").alias("with_before"), F.count("after_values").alias("with_after"))


_CODES = {"signup": WRITE_ROWS, "purchase": UPDATE_ROWS, "error": 2, "view": 32, "click": TABLE_MAP}
_CODE_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in _CODES.items()) + " END"


def _coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.create_map(*(F.lit(x) for pair in _CODES.items() for x in pair))
    return table(spark, sf_dir, "events").withColumn("code", F.element_at(code, F.col("event_type")))


@query(f"SELECT event_id, event_type FROM events WHERE {_CODE_SQL} IN (4, 15, 19, 23, 24, 25, 30, 31, 32, 39)")
def event_type_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coded(spark, sf_dir).filter(filters.kept_event(F.col("code"))).select("event_id", "event_type")


@query(f"SELECT CASE {_CODE_SQL} WHEN 30 THEN 'INSERT' WHEN 31 THEN 'UPDATE' WHEN 32 THEN 'DELETE' END AS dml_type, CASE {_CODE_SQL} WHEN 30 THEN 'WRITE_ROWS_EVENT' WHEN 31 THEN 'UPDATE_ROWS_EVENT' WHEN 32 THEN 'DELETE_ROWS_EVENT' WHEN 19 THEN 'TABLE_MAP_EVENT' ELSE 'UNKNOWN_EVENT' END AS name, count(*) AS n FROM events GROUP BY ALL")
def dml_classify_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = _coded(spark, sf_dir)
    return coded.groupBy(envelope.dml_type(F.col("code")).alias("dml_type"), envelope.event_name(F.col("code")).alias("name")).agg(F.count("*").alias("n"))


# --- table rules ------------------------------------------------------------

_TABLES_SQL = """
WITH t AS (
  SELECT CASE WHEN o_orderkey % 5 < 3 THEN 'tpch' ELSE 'audit' END AS db, CASE o_orderstatus WHEN 'O' THEN 'orders' WHEN 'F' THEN 'error_log' ELSE 'stats' END AS tbl, o_orderkey AS k FROM orders)
"""


def _ruled(name: str, rules: TableRules) -> None:
    """Registers a query of one rule set; its SQL is the nested CASE that the rules mean."""
    cases = []
    for patterns, says in rules.levels():
        cases += [f"WHEN {' AND '.join([f'db = {p.schema!r}'] * bool(p.schema) + [f'tbl = {p.table!r}'] * bool(p.table))} THEN {str(says).lower()}" for p in patterns]
    admits = f"CASE {' '.join(cases)} ELSE {str(rules.otherwise).lower()} END" if cases else str(rules.otherwise).lower()

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = F.col("o_orderkey")
        t = table(spark, sf_dir, "orders").select(
            F.when(F.pmod(key, F.lit(5)) < 3, "tpch").otherwise("audit").alias("db"),
            F.when(F.col("o_orderstatus") == "O", "orders").when(F.col("o_orderstatus") == "F", "error_log").otherwise("stats").alias("tbl"),
        )
        return t.filter(filters.admitted(rules, F.col("db"), F.col("tbl"))).groupBy("db", "tbl").agg(F.count("*").alias("n"))

    QUERIES[name] = run
    ORACLE_SQL[name] = _TABLES_SQL + f"SELECT db, tbl, count(*) AS n FROM t WHERE {admits} GROUP BY ALL"


_ruled("table_filter_none", TableRules())
_ruled("table_filter_whitelist", TableRules(include=("tpch.orders", "audit.stats")))
_ruled("table_filter_blacklist", TableRules(exclude=("tpch.error_log",)))
_ruled("table_filter_mixed", TableRules(include=("tpch.orders", "tpch.*"), exclude=("tpch.stats",)))
_ruled("table_filter_schema_override", TableRules(include=("audit.orders",), exclude=("audit.*",)))
_ruled("table_filter_cross_schema", TableRules(include=("*.stats",), exclude=("audit.*",)))


# --- ranges -----------------------------------------------------------------


@query(CHANGES_SQL + "SELECT binlog_file, log_pos FROM ch WHERE binlog_file = 'binlog.000002' AND log_pos >= 4000 AND log_pos < 20004")
def range_stop_exclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = CaptureSpec(from_binlog_file="binlog.000002", from_binlog_position=4000, to_binlog_file="binlog.000002", to_binlog_position=20_004)
    return filters.in_range(order_changes(spark, sf_dir), spec).select("binlog_file", "log_pos")


@query(CHANGES_SQL + "SELECT binlog_file, log_pos FROM ch WHERE (binlog_file, log_pos) >= ('binlog.000002', 30000) AND (binlog_file < 'binlog.000009' OR binlog_file = 'binlog.000009' AND log_pos < 8004)")
def range_multi_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = CaptureSpec(from_binlog_file="binlog.000002", from_binlog_position=30_000, to_binlog_file="binlog.000009", to_binlog_position=8004)
    return filters.in_range(order_changes(spark, sf_dir), spec).select("binlog_file", "log_pos")


@query(CHANGES_SQL + "SELECT binlog_file, count(*) AS n FROM ch WHERE binlog_file BETWEEN 'binlog.000003' AND 'binlog.000005' GROUP BY 1")
def range_whole_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = CaptureSpec(from_binlog_file="binlog.000003", to_binlog_file="binlog.000005")
    return filters.in_range(order_changes(spark, sf_dir), spec).groupBy("binlog_file").agg(F.count("*").alias("n"))


@query(CHANGES_SQL + "SELECT binlog_file, log_pos FROM ch WHERE binlog_file = 'binlog.000002' AND log_pos >= 10004 AND log_pos < 20000")
def range_position_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = CaptureSpec(from_binlog_file="binlog.000002", from_binlog_position=10_004, to_binlog_position=20_000)
    return filters.in_range(order_changes(spark, sf_dir), spec).select("binlog_file", "log_pos")


@query(CHANGES_SQL + "SELECT CAST(regexp_extract(binlog_file, '\\.([0-9]+)$', 1) AS BIGINT) AS file_number, count(*) AS n FROM ch GROUP BY 1")
def file_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_changes(spark, sf_dir).groupBy(filters.binlog_file_number(F.col("binlog_file")).alias("file_number")).agg(F.count("*").alias("n"))


# --- binding and expansion --------------------------------------------------


@query("""
SELECT l.event_id, r.event_id AS map_id FROM (SELECT * FROM events WHERE event_type <> 'signup') l
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') r ON l.user_id = r.user_id AND l.ts >= r.ts
""")
def asof_bind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with its user's last signup before it, as row events get their table maps."""
    events = table(spark, sf_dir, "events")
    maps = events.filter("event_type = 'signup'").select("user_id", "ts", F.col("event_id").alias("map_id"))
    rows_ = events.filter("event_type <> 'signup'").select("event_id", "user_id", "ts")
    return bind.last_before(rows_, maps, ["user_id"], "ts", "map_id").select("event_id", "map_id")


_LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus"


@query(f"""
SELECT l_orderkey, l_partkey, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS event_row_index FROM lineitem
""")
def explode_ordinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines packed into one event per order, expanded again with their ordinal."""
    line = F.struct(*_LINE_ORDER.split(", "))
    packed = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    flat = packed.select("l_orderkey", F.posexplode("lines").alias("i", "line"))
    return flat.select("l_orderkey", "line.l_partkey", "line.l_extendedprice", (F.col("i") + 1).cast("long").alias("event_row_index"))


# --- scalars ----------------------------------------------------------------


@query(r"""
SELECT doc_id, replace(replace(replace(replace(replace(text, '\', '\\'), '"', '\"'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t') AS escaped FROM documents
""")
def json_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.json_escape(F.col("text")).alias("escaped"))


@query("SELECT doc_id, '0x' || lower(hex(encode(text))) AS hexed FROM documents")
def hex_blob(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.hex_literal(F.col("text").cast("binary")).alias("hexed"))


@query("""
SELECT doc_id, CASE WHEN octet_length(encode(text)) > 256 THEN '<' || octet_length(encode(text)) || ' bytes> 0x' || lower(substr(hex(encode(text)), 1, 64)) || '...'
  ELSE '0x' || lower(hex(encode(text))) END AS preview FROM documents
""")
def blob_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.blob_preview(F.col("text").cast("binary")).alias("preview"))


@query("SELECT l_orderkey, l_linenumber, regexp_replace(CAST(l_extendedprice AS VARCHAR), '\\.0$', '') AS price, regexp_replace(CAST(l_discount AS VARCHAR), '\\.0$', '') AS discount, CAST(l_partkey AS VARCHAR) AS part FROM lineitem")
def number_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    return line.select("l_orderkey", "l_linenumber", text.number_text(F.col("l_extendedprice")).alias("price"), text.number_text(F.col("l_discount")).alias("discount"), text.number_text(F.col("l_partkey")).alias("part"))


@query("SELECT o_orderkey, printf('%.2f', o_totalprice) AS price, printf('%.2f', 1000 - o_totalprice) AS negative FROM orders")
def decimal_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = lambda c: c.cast("decimal(15,2)").cast("string")
    through = lambda c: decimal.decode_decimal(decimal.encode_decimal(c, 15, 2), 15, 2)
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", through(price(F.col("o_totalprice"))).alias("price"), through(price(F.lit(1000) - F.col("o_totalprice"))).alias("negative"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS t, strftime(ts, '%Y-%m-%d %H:%M:%S') AS t0 FROM events")
def datetime2_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = temporal.decode_datetime2(temporal.encode_datetime2(F.col("ts"), 6), 6)
    # a time on the second has no fraction in text; the SQL side always has one
    full = F.when(F.length(full) == 19, F.concat(full, F.lit(".000000"))).otherwise(full)
    return table(spark, sf_dir, "events").select("event_id", full.alias("t"), temporal.decode_datetime2(temporal.encode_datetime2(F.col("ts"))).alias("t0"))


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


@query("SELECT event_id, epoch_us(ts) AS micros, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS t FROM events")
def timestamp2_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    micros = temporal.decode_timestamp2(temporal.encode_timestamp2(_micros("ts"), 6), 6)
    shown = temporal.timestamp_text(micros)
    shown = F.when(F.length(shown) == 20, F.concat(F.substring(shown, 1, 19), F.lit(".000000Z"))).otherwise(shown)
    return table(spark, sf_dir, "events").select("event_id", micros.alias("micros"), shown.alias("t"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders")
def date_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", temporal.decode_date(temporal.encode_date(F.col("o_orderdate"))).alias("d"))


@query("SELECT event_id, epoch_us(ts) % 3000000000000 - 1500000000000 AS micros FROM events")
def time2_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = F.pmod(_micros("ts"), F.lit(3_000_000_000_000)) - 1_500_000_000_000
    return table(spark, sf_dir, "events").select("event_id", temporal.decode_time2(temporal.encode_time2(span, 6), 6).alias("micros"))


@query("SELECT l_orderkey, l_linenumber, l_partkey AS le, l_suppkey AS be, l_orderkey - 30000 AS small, -l_partkey AS wide FROM lineitem")
def int_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    part, small = F.col("l_partkey"), F.col("l_orderkey") - 30_000
    # a key that three bytes can't hold goes in eight, as a table's owner would widen the column
    narrow = small.between(-(1 << 23), (1 << 23) - 1)
    data = F.when(narrow, ints.to_le(small, 3)).otherwise(ints.to_le(small, 8))
    three = F.when(F.length(data) == 3, ints.int24(data)).otherwise(ints.int_le(data, 8))
    return line.select("l_orderkey", "l_linenumber", ints.uint_le(ints.to_le(part, 6), 6).alias("le"), ints.uint_be(ints.to_be(F.col("l_suppkey"), 4), 4).alias("be"), three.alias("small"), ints.int_le(ints.to_le(-part, 8), 8).alias("wide"))


# --- bytes and back ---------------------------------------------------------

_ORDER_COLUMNS = [(8, 0), (8, 0), (15, 4), (5, 8), (18, 0), (15, 60)]


def order_events(spark: SparkSession, sf_dir: str, per_event: int = 20) -> DataFrame:
    """Orders as log events: per file a format description, and statements of a table map and up to ``per_event`` rows."""
    ship(spark)
    orders = place(table(spark, sf_dir, "orders"), F.col("o_orderkey")).drop("server_id")
    stated = orders.withColumn("statement", F.floor(F.pmod(F.col("o_orderkey"), F.lit(1000)) / per_event)).withColumn("at", F.unix_timestamp("o_orderdate"))
    grouped = stated.groupBy("binlog_file", "statement").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", temporal.encode_datetime2(F.col("o_orderdate")).alias("d"), "o_orderpriority"))).alias("rows"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import struct

        from tidemark.sources import encode as enc

        for batch in batches:
            out = []
            for file, statement, found in zip(*(batch.column(c).to_pylist() for c in ("binlog_file", "statement", "rows"))):
                start = 1000 + statement * 100_000
                if statement == 0:
                    out.append((file, 4, FORMAT_DESCRIPTION, enc.format_description()))
                out.append((file, start, TABLE_MAP, enc.table_map(77, "tpch", "orders", _ORDER_COLUMNS)))
                images = [enc.image([r["o_orderkey"].to_bytes(8, "little", signed=True), r["o_custkey"].to_bytes(8, "little", signed=True), enc.varchar(r["o_orderstatus"], 4), struct.pack("<d", r["o_totalprice"]), bytes(r["d"]), enc.varchar(r["o_orderpriority"], 60)]) for r in found]
                out.append((file, start + 100, WRITE_ROWS, enc.rows(WRITE_ROWS, 77, len(_ORDER_COLUMNS), images)))
            names = ["binlog_file", "start_pos", "event_type", "data"]
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds], names=names)

    made = grouped.mapInArrow(encode, "binlog_file string, start_pos long, event_type int, data binary")
    zero = F.lit(0).cast("long")
    return made.withColumns({"timestamp": zero, "server_id": zero + 1, "event_size": F.length("data").cast("long") + 19, "log_pos": F.col("start_pos") + F.length("data") + 19, "flags": F.lit(0)})


@query(CHANGES_SQL + """
SELECT binlog_file, row_number() OVER (PARTITION BY o_orderkey // 20 ORDER BY o_orderkey) AS event_row_index, 'tpch' AS database, 'orders' AS table_name, 'INSERT' AS dml_type,
       head || regexp_replace(CAST(o_totalprice AS VARCHAR), '\\.0$', '') || tail AS after_values
FROM i
""")
def row_event_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders encoded as row events, bound to their table maps and decoded in one pass."""
    decoded = decode.decode(order_events(spark, sf_dir))
    return decoded.select("binlog_file", "event_row_index", "database", "table_name", "dml_type", "after_values")


@query("SELECT event_id, props AS decoded FROM events")
def json_binary_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Props as binary JSON and back."""
    ship(spark)

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tidemark.sources.encode import json_binary_of_text
        from tidemark.sources.wire import json_text

        for batch in batches:
            out = [json_text(json_binary_of_text(p, k % 2 == 1)) for k, p in enumerate(batch.column("props").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("event_id"), pa.array(out, pa.string())], names=["event_id", "decoded"])

    return table(spark, sf_dir, "events").select("event_id", "props").mapInArrow(through, "event_id long, decoded string")


# --- counters, batches, sinks -----------------------------------------------


@query(CHANGES_SQL + "SELECT binlog_file, log_pos, (row_number() OVER (PARTITION BY binlog_file ORDER BY log_pos, event_row_index) - 1) // 128 AS batch FROM ch")
def batch_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.with_batches(order_changes(spark, sf_dir), 128).select("binlog_file", "log_pos", F.col("batch").cast("long").alias("batch"))


@query("""
WITH m AS (SELECT user_id, min(CASE WHEN event_id % 7 <> 0 THEN event_id END) AS s, max(event_id * 10) AS end_ns, count(*) AS rows_processed, sum(event_id % 100) AS bytes_written FROM events GROUP BY 1)
SELECT user_id, coalesce(s, 0) AS start_ns, end_ns, rows_processed, CAST(bytes_written AS BIGINT) AS bytes_written,
       CASE WHEN end_ns - coalesce(s, 0) > 0 THEN rows_processed / ((end_ns - coalesce(s, 0)) / 1e9) ELSE 0.0 END AS rows_per_second FROM m
""")
def metrics_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    parts = table(spark, sf_dir, "events").select("user_id", F.when(F.pmod(event, F.lit(7)) != 0, event).otherwise(0).alias("start_ns"), (event * 10).alias("end_ns"), F.lit(1).cast("long").alias("rows_processed"), F.pmod(event, F.lit(100)).alias("bytes_written"))
    return metrics.throughput(metrics.merge(parts, "user_id"))


@query(CHANGES_SQL + "SELECT count(*) AS events_read, count(*) FILTER (WHERE dml_type = 'DELETE') AS tables_filtered FROM ch")
def filter_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = order_changes(spark, sf_dir)
    rules = TableRules(exclude=("tpch.DELETE",))
    return metrics.filter_counts(changes, filters.admitted(rules, F.col("database"), F.col("dml_type")))


@query(CHANGES_SQL + "SELECT binlog_file, count(*) AS rows, min(log_pos) AS first_pos, max(log_pos) AS last_pos FROM ch GROUP BY 1")
def rotate_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by the log file that names their output."""
    return order_changes(spark, sf_dir).groupBy("binlog_file").agg(F.count("*").alias("rows"), F.min("log_pos").alias("first_pos"), F.max("log_pos").alias("last_pos"))


def _scratch(spark: SparkSession, name: str) -> str:
    """A folder that driver and executors share: the checkpoint folder, or one of our own in a local session without one."""
    import tempfile
    import uuid

    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="tidemark-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query(CHANGES_SQL + "SELECT * FROM ch")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change rows written as Parquet per log file and read again."""
    folder = _scratch(spark, "parquet")
    names = sinks.write_parquet(order_changes(spark, sf_dir), folder)
    read = spark.read.parquet(*(f"{folder}/{n}.parquet" for n in names))
    file = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)\.parquet/[^/]+$", 1)
    return read.select(file.alias("binlog_file"), *read.columns)


@query(CHANGES_SQL + """
SELECT '[' || dml_type || '] tpch.orders' || chr(10) || '  at: ' || binlog_file || ':' || log_pos || ' row 1' || chr(10) || '  server: ' || server_id || '  time: ' || timestamp
  || coalesce(chr(10) || '  before: ' || before_values, '') || coalesce(chr(10) || '  after: ' || after_values, '') AS value FROM ch
""")
def text_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.change_text(order_changes(spark, sf_dir))


# --- questions on changes ---------------------------------------------------

_CUSTOMER_SQL = CHANGES_SQL + ", k AS (SELECT *, json_extract_string(coalesce(after_values, before_values), '$.c1') AS key FROM ch)"


@query(_CUSTOMER_SQL + """
, l AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY binlog_file DESC, log_pos DESC) AS n FROM k)
SELECT database, table_name, key, after_values AS image FROM l WHERE n = 1 AND dml_type <> 'DELETE'
""")
def current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last image per customer."""
    return analytics.current_state(order_changes(spark, sf_dir), "c1")


@query(CHANGES_SQL + "SELECT timestamp // 86400 * 86400 AS window_start, table_name, dml_type, count(*) AS changes FROM ch GROUP BY ALL")
def changelog_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.changelog_windows(order_changes(spark, sf_dir))


@query(CHANGES_SQL + "SELECT log_pos, binlog_file, 'c3' AS changed FROM ch WHERE dml_type = 'UPDATE'")
def changed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.changed_columns(order_changes(spark, sf_dir)).select("log_pos", "binlog_file", "changed")


@query(_CUSTOMER_SQL + "SELECT binlog_file, log_pos, key, row_number() OVER (PARTITION BY key ORDER BY binlog_file, log_pos) AS version FROM k")
def row_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = analytics.row_versions(order_changes(spark, sf_dir), "c1")
    return out.select("binlog_file", "log_pos", "key", F.col("version").cast("long").alias("version"))


