"""Helpers that several corpus operators share."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.shipping import ship

#: The white space of every contract here: space, tab, line feed, vertical tab,
#: form feed, carriage return.
SPACE_CHARS = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Bytes of one Arrow batch to or from a Python worker, unless one row is longer.
ARROW_BYTES = 1 << 20


def words_in(text: Column) -> Column:
    """Number of maximal runs without white space; 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_PATTERN)).cast("long")


def without_space(text: Column) -> Column:
    """The text with every white-space character deleted; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACE_CHARS, "")


def uniform(*cols: Column) -> Column:
    """A number in [0, 1) that depends on the given values only."""
    return F.xxhash64(*cols).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))


def keep(df: DataFrame) -> DataFrame:
    """Hold a narrow table (never texts) that several jobs read.

    Blocks lost with an executor are computed anew from the input, so this is a
    cache and not a cut of the lineage.
    """
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def ready(spark: SparkSession) -> None:
    """Give Python workers the package, and Arrow batches a size that does not follow the rows'.

    A batch of 10,000 long texts would take hundreds of megabytes in the executor and again in its
    worker; a session that already asks for less than ARROW_BYTES keeps its setting.
    """
    ship(spark)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    if not 0 < now <= ARROW_BYTES:
        spark.conf.set(name, str(ARROW_BYTES))


def ensure_checkpoint_dir(df: DataFrame) -> None:
    """Leave the cluster's spark.checkpoint.dir alone; set one only where none is named."""
    spark = df.sparkSession
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return
    import tempfile

    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-checkpoint-"))


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write the table as Parquet to the shared checkpoint folder and read it again."""
    ensure_checkpoint_dir(df)
    spark = df.sparkSession
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    path = f"{shared.rstrip('/')}/tidemark/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Write the table to the shared checkpoint folder and go on from there."""
    ensure_checkpoint_dir(df)
    return df.checkpoint(eager=True)


def join_groups(rows: DataFrame, groups: DataFrame, key: str | Column) -> DataFrame:
    """Inner join of rows with one row per group.

    A group may hold much of the table: with the groups' side unique by key,
    adaptive execution splits such a group's rows over many tasks and copies its
    one row to them.
    """
    return rows.join(groups, key)


def without_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id", broadcast_rows: int = 1_000_000) -> DataFrame:
    """Documents whose id is not among ``ids`` (null ids stay).

    The ids are broadcast only if a count shows at most ``broadcast_rows`` of
    them (8 bytes each); beyond that both sides are shuffled.
    """
    ids = keep(ids.select(F.col(key).alias("_gone")).filter("_gone IS NOT NULL").distinct())
    side = F.broadcast(ids) if ids.count() <= broadcast_rows else ids
    return docs.join(side, docs[key] == side["_gone"], "left_anti")
