"""A change stream made from the driver's tables, the same in Spark and in SQL.

Rules: database ``tpch``; server 1 + key % 3; file ``binlog.NNNNNN`` with 1,000
keys; position 4 + 40 x (key % 1,000 + 1); an order is inserted (O), updated (F)
or deleted (P) by its status; the image before an update has a price less by 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.temporal import datetime_text
from tidemark.functions.text import json_string, number_text, quoted, row_json
from tidemark.operators.envelope import with_images

KEYS_PER_FILE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def place(df: DataFrame, key: Column) -> DataFrame:
    """binlog_file, server_id, log_pos of a key."""
    number = F.lpad((F.floor(key / KEYS_PER_FILE) + 1).cast("string"), 6, "0")
    return df.withColumns(
        {
            "binlog_file": F.concat(F.lit("binlog."), number),
            "server_id": (F.pmod(key, F.lit(3)) + 1).cast("int"),
            "log_pos": F.lit(4).cast("long") + 40 * (F.pmod(key, F.lit(KEYS_PER_FILE)) + 1),
        }
    )


def order_image(price: Column) -> Column:
    return row_json([F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), json_string(F.col("o_orderstatus")), number_text(price), quoted(datetime_text(F.col("o_orderdate"))), json_string(F.col("o_orderpriority"))])


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """binlog_file and the envelope of every order's change."""
    orders = place(table(spark, sf_dir, "orders"), F.col("o_orderkey"))
    dml = F.when(F.col("o_orderstatus") == "O", "INSERT").when(F.col("o_orderstatus") == "F", "UPDATE").otherwise("DELETE")
    price = F.col("o_totalprice")
    before = order_image(F.when(dml == "UPDATE", F.round(price - 1, 2)).otherwise(price))
    out = with_images(orders, dml, before, order_image(price))
    return out.select(
        "binlog_file",
        F.unix_timestamp("o_orderdate").alias("timestamp"),
        "server_id",
        "log_pos",
        F.lit(1).cast("long").alias("event_row_index"),
        F.lit("tpch").alias("database"),
        F.lit("orders").alias("table_name"),
        "dml_type",
        "before_values",
        "after_values",
    )


#: The same in SQL, as a common table expression named ch.
CHANGES_SQL = r"""
WITH o AS (
  SELECT *, printf('binlog.%06d', 1 + o_orderkey // 1000) AS binlog_file, 4 + 40 * (o_orderkey % 1000 + 1) AS log_pos,
         CASE o_orderstatus WHEN 'O' THEN 'INSERT' WHEN 'F' THEN 'UPDATE' ELSE 'DELETE' END AS dml_type,
         '"' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '"' AS d
  FROM orders),
i AS (
  SELECT *, '{"c0":' || o_orderkey || ',"c1":' || o_custkey || ',"c2":"' || o_orderstatus || '","c3":' AS head,
         ',"c4":' || d || ',"c5":"' || replace(replace(o_orderpriority, '\', '\\'), '"', '\"') || '"}' AS tail
  FROM o),
ch AS (
  SELECT binlog_file, CAST(epoch(o_orderdate) AS BIGINT) AS timestamp, CAST(1 + o_orderkey % 3 AS INTEGER) AS server_id, log_pos,
         CAST(1 AS BIGINT) AS event_row_index, 'tpch' AS database, 'orders' AS table_name, dml_type,
         CASE WHEN dml_type <> 'INSERT' THEN head || regexp_replace(CAST(CASE WHEN dml_type = 'UPDATE' THEN round(o_totalprice - 1, 2) ELSE o_totalprice END AS VARCHAR), '\.0$', '') || tail END AS before_values,
         CASE WHEN dml_type <> 'DELETE' THEN head || regexp_replace(CAST(o_totalprice AS VARCHAR), '\.0$', '') || tail END AS after_values
  FROM i)
"""
