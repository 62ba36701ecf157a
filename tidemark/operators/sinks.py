"""Where change rows go: Parquet per log file, text, and the run's own log."""

from __future__ import annotations

import logging
import sys
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.text import json_escape
from tidemark.operators.envelope import to_envelope

#: A Parquet layout that any reader takes: gzip, plain values, row groups of one batch.
STRETCH = 64 << 20
LAYOUT = {"compression": "gzip", "parquet.enable.dictionary": "false"}


def write_parquet(changes: DataFrame, folder: str, batch_rows: int = 8192, codec: str = "gzip") -> list[str]:
    """Write ``{folder}/{binlog_file}.parquet`` per log file and return the names.

    All files are written by one job: rows are dealt out by file and stretch of
    ``STRETCH`` log bytes, so a large file has many writers and every part is in
    log order (dealing by range would decode everything twice, once to sample).
    The job writes to a staging folder of its own; then each file's old output is
    moved aside, the new one put in place by a rename on the same store, and the
    old one deleted. Rows with ``_error`` are not written here.
    """
    # the envelope drops the file, which names the output
    rows = to_envelope_with_file(changes).repartition("_file", F.floor(F.col("log_pos") / STRETCH)).sortWithinPartitions("_file", "log_pos", "event_row_index")
    root = f"{folder.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    rows.write.options(**LAYOUT | {"compression": codec, "parquet.block.row.count.limit": batch_rows}).partitionBy("_file").parquet(f"{root}/new")
    spark = changes.sparkSession
    store, path = _store(spark, root)
    names = []
    for status in store.listStatus(path(f"{root}/new")):
        part = status.getPath().getName()
        if part.startswith("_file="):
            name = spark._jvm.java.net.URLDecoder.decode(part.removeprefix("_file="), "UTF-8")
            _put(store, status.getPath(), path(f"{folder.rstrip('/')}/{name}.parquet"), path(f"{root}/old-{part}"))
            names.append(name)
    store.delete(path(root), True)
    return sorted(names)


def _store(spark: SparkSession, folder: str):
    jvm = spark._jvm.org.apache.hadoop.fs
    return jvm.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration()), jvm.Path


def _put(store, new, target, aside) -> None:
    if store.exists(target) and not store.rename(target, aside):
        raise OSError(f"can't move {target} aside")
    if not store.rename(new, target):
        raise OSError(f"can't put {target} in place; what was there is {aside}")


def write_quarantine(faults: DataFrame, folder: str) -> None:
    """Write what could not be decoded to ``{folder}/_quarantine``: where it is, and why."""
    chosen = faults.select("binlog_file", "log_pos", "event_row_index", "database", "table_name", "dml_type", F.col("_error").alias("reason"))
    chosen.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/_quarantine")


def clear_quarantine(spark: SparkSession, folder: str) -> None:
    store, path = _store(spark, folder)
    store.delete(path(f"{folder.rstrip('/')}/_quarantine"), True)


def bytes_in(spark: SparkSession, folder: str, names: list[str]) -> int:
    """Size of the output of these files."""
    store, path = _store(spark, folder)
    return sum(store.getContentSummary(path(f"{folder.rstrip('/')}/{n}.parquet")).getLength() for n in names)


def to_envelope_with_file(changes: DataFrame) -> DataFrame:
    kept = changes.filter("_error IS NULL") if "_error" in changes.columns else changes
    return kept.select(F.col("binlog_file").alias("_file"), *(F.col(c) for c in ("timestamp", "server_id", "log_pos", "event_row_index", "database", "table_name", "dml_type", "before_values", "after_values")))


def change_text(changes: DataFrame) -> DataFrame:
    """One string column ``value``: a labelled block per change row."""
    label = F.concat(F.lit("["), F.col("dml_type"), F.lit("] "), F.coalesce("database", F.lit("?")), F.lit("."), F.coalesce("table_name", F.lit("?")))
    where = F.concat(F.lit("  at: "), F.col("binlog_file"), F.lit(":"), F.col("log_pos").cast("string"), F.lit(" row "), F.col("event_row_index").cast("string"))
    who = F.concat(F.lit("  server: "), F.col("server_id").cast("string"), F.lit("  time: "), F.col("timestamp").cast("string"))
    image = lambda name, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"  {name}: "), F.col(c)))
    return changes.select(F.concat_ws("\n", label, where, who, image("before", "before_values"), image("after", "after_values")).alias("value"))


def event_text(events: DataFrame, *keys: str | Column) -> DataFrame:
    """A string column ``value`` besides the keys: a block of the header's fields per event."""
    from tidemark.operators.envelope import event_name

    fields = [("type", F.concat(event_name(F.col("event_type")), F.lit(" ("), F.col("event_type").cast("string"), F.lit(")"))), *((c, F.col(c).cast("string")) for c in ("timestamp", "server_id", "event_size", "log_pos", "flags")), ("data", F.concat(F.length("data").cast("string"), F.lit(" bytes")))]
    return events.select(*keys, F.concat_ws("\n", F.lit("[EVENT]"), *(F.concat(F.lit(f"  {n}: "), v) for n, v in fields)).alias("value"))


def write_text(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def print_blocks(blocks: DataFrame) -> int:
    """Print blocks to standard output in log order, a partition at a time; returns how many."""
    count = 0
    for row in blocks.orderBy("binlog_file", "log_pos", "event_row_index").select("value").toLocalIterator():
        sys.stdout.write(row[0] + "\n")
        count += 1
    return count


def log_lines(changes: DataFrame) -> DataFrame:
    """Change rows as JSON lines."""
    pick = F.concat(F.lit('{"table":"'), json_escape(F.concat_ws(".", "database", "table_name")), F.lit('","dml":"'), F.col("dml_type"), F.lit('","before":'), F.coalesce("before_values", F.lit("null")), F.lit(',"after":'), F.coalesce("after_values", F.lit("null")), F.lit("}"))
    return changes.select(pick.alias("value"))


def start_log(level: str = "info", file: str | None = None) -> logging.Logger:
    """The run's log, on standard error or in a file begun anew."""
    log = logging.getLogger("tidemark")
    log.setLevel({"debug": logging.DEBUG, "info": logging.INFO, "warn": logging.WARNING, "warning": logging.WARNING, "err": logging.ERROR, "error": logging.ERROR}[level.lower()])
    log.handlers[:] = [logging.FileHandler(file, mode="w") if file else logging.StreamHandler(sys.stderr)]
    log.handlers[0].setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
    return log


__all__ = ["LAYOUT", "bytes_in", "change_text", "clear_quarantine", "event_text", "log_lines", "print_blocks", "start_log", "to_envelope", "write_parquet", "write_quarantine", "write_text"]
