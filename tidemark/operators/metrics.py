"""Counters of a run: partial sums that merge in any order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from tidemark.operators.decode import FILTERED, UNBOUND

COUNTERS = ("rows_processed", "batches_flushed", "bytes_written", "processing_ns", "flush_ns")


def merge(parts: DataFrame, *by: str) -> DataFrame:
    """Counters add up; the start is the least that isn't 0, the end the greatest."""
    sums = [F.sum(c).alias(c) for c in COUNTERS if c in parts.columns]
    start = F.coalesce(F.min(F.when(F.col("start_ns") != 0, F.col("start_ns"))), F.lit(0).cast("long"))
    return parts.groupBy(*by).agg(start.alias("start_ns"), F.coalesce(F.max("end_ns"), F.lit(0).cast("long")).alias("end_ns"), *sums)


def throughput(merged: DataFrame) -> DataFrame:
    """rows_per_second over the elapsed time; 0 without any."""
    seconds = (F.col("end_ns") - F.col("start_ns")) / 1e9
    return merged.withColumn("rows_per_second", F.when(seconds > 0, F.col("rows_processed") / seconds).otherwise(0.0))


def batch_number(rows: Column, size: int) -> Column:
    """Fixed-size batches from a row number that starts at 1."""
    return F.floor((rows - 1) / size)


def with_batches(changes: DataFrame, size: int = 8192) -> DataFrame:
    """``batch`` within each log file, in log order. A file bounds the window."""
    order = Window.partitionBy("binlog_file").orderBy("log_pos", "event_row_index")
    return changes.withColumn("batch", batch_number(F.row_number().over(order), size))


def observed(df: DataFrame, name: str = "capture", counter: str = "rows_processed") -> tuple[DataFrame, Observation]:
    """Counts rows as they pass, without a pass of its own."""
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias(counter)), watch


def watched(changes: DataFrame, name: str = "decode") -> tuple[DataFrame, Observation]:
    """Counts reported change rows by what became of them, without a pass of its own."""
    watch = Observation(name)
    fault = F.col("_error")
    kinds = {"rows_processed": fault.isNull(), "events_unbound": fault == UNBOUND, "tables_filtered": fault == FILTERED, "rows_quarantined": fault.isNotNull() & ~fault.isin(UNBOUND, FILTERED)}
    return changes.observe(watch, *(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in kinds.items())), watch


def filter_counts(events: DataFrame, admitted: Column) -> DataFrame:
    """events_read and tables_filtered over bound events."""
    return events.agg(F.count(F.lit(1)).alias("events_read"), F.count_if(~admitted).alias("tables_filtered"))
