"""Exact duplicates by two-pass Bloom filtering, in DataFrame functions only.

Pass 1 hashes each normalised text to a cell of a filter with at least 32 cells
a row and finds the cells that were hit more than once; what moves is one long
per row, combined before the shuffle: a filter of a whole corpus would be larger than
that, and one such filter per task larger still. The cells that were hit again are
folded into a second filter, of 32 bits for each of them and at most
``filter_bits``, and broadcast as 4 KB bitmaps. In pass 2 every row tests its bit:
a row that misses is certainly the only one of its kind and goes straight to the
result; only rows that hit are shuffled and grouped by the full SHA-256. Where the
second filter meets its bound it passes more rows that turn out to be unique,
never fewer that are not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import join_groups, keep, without_space

#: Bits of one bitmap made by bitmap_construct_agg.
BITMAP_BITS = 32768


def exact_dedup(docs: DataFrame, filter_bits: int = 1 << 28) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without their white space; of equal texts the
    row with the most code points stays, then the smallest doc_id. Defined cases:
    a null text counts as empty; all empty texts are one group; a null doc_id
    loses every tie and stays only in a group without ids; rows that repeat the
    staying row's doc_id are all marked kept; an empty table gives no rows; other
    columns of the input are ignored.
    """
    rows = keep(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.length(F.coalesce("text", F.lit(""))).alias("_n"),
            F.unhex(F.sha2(without_space(F.col("text")).cast("binary"), 256)).alias("_sha"),
        )
    )
    cells = 1 << max(20, (32 * max(rows.count(), 1) - 1).bit_length())
    cell = F.pmod(F.xxhash64("_sha"), F.lit(cells))

    repeated = keep(rows.groupBy(cell.alias("_cell")).agg(F.count("*").alias("_hits")).filter("_hits > 1").select("_cell"))
    # a divisor of the number of cells, so that folding keeps a row's bit
    bits = min(cells, filter_bits, max(BITMAP_BITS, 1 << (32 * max(repeated.count(), 1) - 1).bit_length()))
    folded = F.pmod(F.col("_cell"), F.lit(bits))
    bitmaps = repeated.groupBy(F.floor(folded / BITMAP_BITS).alias("_map")).agg(
        F.bitmap_construct_agg(F.pmod(folded, F.lit(BITMAP_BITS))).alias("_bits")
    )

    position = F.pmod(cell, F.lit(bits))
    bit = F.pmod(position, F.lit(BITMAP_BITS)).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    tested = (
        rows.withColumn("_map", F.floor(position / BITMAP_BITS))
        .join(F.broadcast(bitmaps), "_map", "left")
        .withColumn("_maybe", F.col("_bits").isNotNull() & (F.expr("1") == F.call_function("shiftright", byte, F.pmod(bit, F.lit(8))).bitwiseAND(F.lit(1))))
        .select("doc_id", "_n", "_sha", F.coalesce("_maybe", F.lit(False)).alias("_maybe"))
    )
    alone = tested.filter(~F.col("_maybe")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "_sha")

    maybe = tested.filter("_maybe").select("doc_id", "_n", "_sha")
    best = F.max(F.struct(F.col("_n"), F.bitwise_not(F.col("doc_id")).alias("_id")))
    groups = maybe.groupBy("_sha").agg(F.count("*").alias("group_size"), best.alias("_best"))
    groups = groups.select("_sha", "group_size", F.bitwise_not(F.col("_best._id")).alias("keep_id"))
    shared = join_groups(maybe.select("doc_id", "_sha"), groups, "_sha")

    return alone.unionByName(shared).select(
        "doc_id",
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


ORACLE_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
