"""A capture from its spec: source, binding, table rules, decoding, range, sink."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.bind import bind
from tidemark.operators.decode import FILTERED, decode
from tidemark.operators.filters import admitted, in_range, kept_event
from tidemark.operators.metrics import observed, watched
from tidemark.operators.rows import display
from tidemark.operators.sinks import bytes_in, clear_quarantine, event_text, print_blocks, start_log, write_parquet, write_quarantine
from tidemark.schema import ROW_EVENTS
from tidemark.shipping import ship
from tidemark.sources.binlog import register
from tidemark.sources.replication import ReplicationSource
from tidemark.spec import CaptureSpec


def read_events(spark: SparkSession, path: str, spec: CaptureSpec | None = None) -> DataFrame:
    """Events of the log files at ``path``, pruned to the spec's files and positions by the reader."""
    register(spark)
    reader = spark.read.format("binlog").option("path", path)
    if spec:
        reader = reader.option("from_file", spec.from_binlog_file).option("from_pos", spec.from_binlog_position)
        if spec.to_binlog_file:
            reader = reader.option("to_file", spec.to_binlog_file)
            if spec.to_binlog_position:
                reader = reader.option("to_pos", spec.to_binlog_position)
    return reader.load()


def replicated_events(spark: SparkSession, spec: CaptureSpec, verify: bool = True) -> DataFrame:
    """Events straight from the spec's server, up to its stop or the log's end, in one partition."""
    ship(spark)
    spark.dataSource.register(ReplicationSource)
    return spark.read.format("replication").options(**_server(spec, verify)).load()


def replicated_stream(spark: SparkSession, spec: CaptureSpec, verify: bool = True, max_events: int = 10_000) -> DataFrame:
    """Events of the spec's server as a stream that goes on with what is logged meanwhile."""
    ship(spark)
    spark.dataSource.register(ReplicationSource)
    reader = spark.readStream.format("replication").options(**_server(spec, verify), max_events=max_events)
    return reader.load()


def _server(spec: CaptureSpec, verify: bool) -> dict:
    options = dict(host=spec.host, port=spec.port, user=spec.user, password=spec.password, database=spec.database, ssl=spec.ssl, ssl_verify=verify, from_file=spec.from_binlog_file, from_pos=spec.from_binlog_position)
    return options | {k: v for k, v in (("to_file", spec.to_binlog_file), ("to_pos", spec.to_binlog_position)) if v is not None}


def selected(events: DataFrame, spec: CaptureSpec) -> DataFrame:
    """Bound row events within the range, of the tables that the rules admit.

    Catalyst can't push a predicate through the decoder, so range, event kind
    and table rules stand before it: what is left out is never decoded.
    """
    # table maps before the start position are still needed, so only rows are cut to the range
    bound = in_range(bind(events.filter(kept_event(F.col("event_type")))), spec)
    return bound.filter(admitted(spec.rules, F.col("table.database"), F.col("table.table_name")))


def changes(events: DataFrame, spec: CaptureSpec, ordered: bool = False) -> DataFrame:
    """Change rows of the spec's range and tables."""
    return decode(events, spec, ordered=ordered)


def run(spark: SparkSession, path: str | None, spec: CaptureSpec) -> dict[str, float]:
    """Read (log files at a path, else the spec's server), decode and write; returns the counters.

    What can't be decoded is counted, and in Parquet mode written to
    ``_quarantine`` with its place and reason. A fault of the run itself stops it
    before output is put in place. Text mode prints other events too at log level
    debug.
    """
    log = start_log(spec.log_level, spec.log_file)
    began = time.perf_counter()
    events = read_events(spark, path, spec) if path else replicated_events(spark, spec)
    counts: dict[str, float] = {}
    if spec.output_mode == "parquet":
        folder = spec.parquet_output_dir
        seen, read = observed(events, "events", "events_read")
        reported, watch = watched(decode(seen, spec, ordered=True, report=True))
        names = write_parquet(reported, folder, spec.parquet_batch_size)
        counts = {**read.get, **watch.get, "bytes_written": bytes_in(spark, folder, names), "files_written": len(names)}
        if counts["rows_quarantined"] or counts["events_unbound"]:
            faults = decode(events, spec, ordered=True, report=True).filter(F.col("_error").isNotNull() & (F.col("_error") != FILTERED))
            write_quarantine(faults, folder)
            log.warning("%d rows and %d events set aside in %s/_quarantine", counts["rows_quarantined"], counts["events_unbound"], folder)
        else:
            clear_quarantine(spark, folder)
        log.info("wrote %s", ", ".join(names) or "nothing")
    else:
        blocks = display(selected(events, spec))
        if spec.log_level.lower() == "debug":
            others = events.filter(~F.col("event_type").isin(*ROW_EVENTS))
            blocks = blocks.unionByName(event_text(others, "binlog_file", "log_pos", F.lit(0).cast("long").alias("event_row_index")))
        counts["rows_processed"] = print_blocks(blocks)
    counts["elapsed_ms"] = round(1000 * (time.perf_counter() - began), 3)
    counts["rows_per_second"] = round(counts["rows_processed"] / max(counts["elapsed_ms"], 1e-3) * 1000, 1)
    log.info(", ".join(f"{k} {v}" for k, v in counts.items()))
    return counts
