"""Schemas of events, table maps and change rows, and the codes of the binary log."""

from __future__ import annotations

from pyspark.sql import types as T

# Event type codes of the public binary log format.
ROTATE, FORMAT_DESCRIPTION, TABLE_MAP = 4, 15, 19
WRITE_ROWS_V1, UPDATE_ROWS_V1, DELETE_ROWS_V1 = 23, 24, 25
WRITE_ROWS, UPDATE_ROWS, DELETE_ROWS, PARTIAL_UPDATE_ROWS = 30, 31, 32, 39
ROW_EVENTS = (WRITE_ROWS_V1, UPDATE_ROWS_V1, DELETE_ROWS_V1, WRITE_ROWS, UPDATE_ROWS, DELETE_ROWS, PARTIAL_UPDATE_ROWS)
KEPT_EVENTS = (ROTATE, FORMAT_DESCRIPTION, TABLE_MAP, *ROW_EVENTS)
DML = {
    WRITE_ROWS_V1: "INSERT", WRITE_ROWS: "INSERT",
    UPDATE_ROWS_V1: "UPDATE", UPDATE_ROWS: "UPDATE", PARTIAL_UPDATE_ROWS: "UPDATE",
    DELETE_ROWS_V1: "DELETE", DELETE_ROWS: "DELETE",
}
EVENT_NAMES = {
    ROTATE: "ROTATE_EVENT", FORMAT_DESCRIPTION: "FORMAT_DESCRIPTION_EVENT", TABLE_MAP: "TABLE_MAP_EVENT",
    WRITE_ROWS_V1: "WRITE_ROWS_EVENT_V1", UPDATE_ROWS_V1: "UPDATE_ROWS_EVENT_V1", DELETE_ROWS_V1: "DELETE_ROWS_EVENT_V1",
    WRITE_ROWS: "WRITE_ROWS_EVENT", UPDATE_ROWS: "UPDATE_ROWS_EVENT", DELETE_ROWS: "DELETE_ROWS_EVENT",
    PARTIAL_UPDATE_ROWS: "PARTIAL_UPDATE_ROWS_EVENT",
}

# Column type codes of the public protocol.
TYPE_NAMES = {
    0: "DECIMAL", 1: "TINY", 2: "SHORT", 3: "LONG", 4: "FLOAT", 5: "DOUBLE", 6: "NULL", 7: "TIMESTAMP", 8: "LONGLONG",
    9: "INT24", 10: "DATE", 11: "TIME", 12: "DATETIME", 13: "YEAR", 14: "NEWDATE", 15: "VARCHAR", 16: "BIT",
    17: "TIMESTAMP2", 18: "DATETIME2", 19: "TIME2", 245: "JSON", 246: "NEWDECIMAL", 247: "ENUM", 248: "SET",
    249: "TINY_BLOB", 250: "MEDIUM_BLOB", 251: "LONG_BLOB", 252: "BLOB", 253: "VAR_STRING", 254: "STRING", 255: "GEOMETRY",
}
TYPE_CODES = {name: code for code, name in TYPE_NAMES.items()}

HEADER_BYTES = 19
MAGIC = b"\xfebin"
FIRST_POSITION = 4

ENVELOPE = T.StructType(
    [
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("server_id", T.IntegerType(), False),
        T.StructField("log_pos", T.LongType(), False),
        T.StructField("event_row_index", T.LongType(), False),
        T.StructField("database", T.StringType(), True),
        T.StructField("table_name", T.StringType(), True),
        T.StructField("dml_type", T.StringType(), False),
        T.StructField("before_values", T.StringType(), True),
        T.StructField("after_values", T.StringType(), True),
    ]
)

EVENT = T.StructType(
    [
        T.StructField("binlog_file", T.StringType(), False),
        T.StructField("start_pos", T.LongType(), False),
        T.StructField("event_type", T.IntegerType(), False),
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("server_id", T.LongType(), False),
        T.StructField("event_size", T.LongType(), False),
        T.StructField("log_pos", T.LongType(), False),
        T.StructField("flags", T.IntegerType(), False),
        T.StructField("data", T.BinaryType(), False),
    ]
)

TABLE_MAP_STRUCT = T.StructType(
    [
        T.StructField("table_id", T.LongType()),
        T.StructField("database", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("columns", T.ArrayType(T.StructType([T.StructField("type", T.IntegerType()), T.StructField("meta", T.IntegerType())]))),
    ]
)

#: A change row inside the engine: the envelope, where it comes from, and why it could not be decoded.
CHANGES = T.StructType([T.StructField("binlog_file", T.StringType(), False), *ENVELOPE.fields, T.StructField("_error", T.StringType(), True)])
