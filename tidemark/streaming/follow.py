"""Following a log with Structured Streaming.

The source ends every micro-batch between statements, so each batch binds its
row events by itself and no state is carried; the checkpoint holds the file and
position to go on from. Each batch is written once per log file and batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.sinks import to_envelope_with_file
from tidemark.plans.capture import changes
from tidemark.sources.binlog import register
from tidemark.spec import CaptureSpec


def read_stream(spark: SparkSession, path: str, spec: CaptureSpec, max_events: int = 10_000) -> DataFrame:
    """The log's events as a stream from the spec's start."""
    register(spark)
    return spark.readStream.format("binlog").option("path", path).option("from_file", spec.from_binlog_file).option("from_pos", spec.from_binlog_position).option("max_events", max_events).load()


def follow(events: DataFrame, spec: CaptureSpec, folder: str, checkpoint: str, available_now: bool = True, written: Callable[[int], None] | None = None) -> StreamingQuery:
    """Write the stream's change rows under ``folder``, in a part per batch that a rerun replaces; ``written`` is told each batch's number.

    Events must be in the order in which the data sources give them, what a batch
    has of a file in one partition.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = to_envelope_with_file(changes(batch, spec, ordered=True)).withColumn("_batch", F.lit(number))
        (rows.sortWithinPartitions("_batch", "_file", "log_pos", "event_row_index").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip").partitionBy("_batch", "_file").parquet(folder))
        if written:
            written(number)

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def catch_up(spark: SparkSession, path: str, spec: CaptureSpec, folder: str, checkpoint: str, max_events: int = 10_000) -> int:
    """Follow the log, ``max_events`` or so at a time, until there is nothing new; returns the batches written.

    One query runs through all batches: the source gives one batch to a query that
    takes what is available now, and a query's start costs more than a batch.
    """
    batches: list[int] = []
    query = follow(read_stream(spark, path, spec, max_events), spec, folder, checkpoint, available_now=False, written=batches.append)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return len(set(batches))


def windowed_counts(changes_stream: DataFrame, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Changes per window and table of a stream of change rows; rows later than the watermark are left out."""
    timed = changes_stream.withColumn("event_time", F.timestamp_seconds("timestamp")).withWatermark("event_time", late)
    return timed.groupBy(F.window("event_time", width), "database", "table_name").agg(F.count(F.lit(1)).alias("changes"))
