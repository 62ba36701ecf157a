"""Questions on change rows: what a table holds now, how much changes, which columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def current_state(changes: DataFrame, key: str = "c0") -> DataFrame:
    """The last image of each key per table, without keys whose last change deletes them."""
    image = F.coalesce("after_values", "before_values")
    keyed = changes.withColumn("key", F.get_json_object(image, f"$.{key}"))
    place = F.struct("binlog_file", "log_pos", "event_row_index")
    last = keyed.groupBy("database", "table_name", "key").agg(F.max_by(F.struct("dml_type", "after_values"), place).alias("l"))
    return last.filter("l.dml_type <> 'DELETE'").select("database", "table_name", "key", F.col("l.after_values").alias("image"))


def changelog_windows(changes: DataFrame, width: str = "1 day") -> DataFrame:
    """Changes per window of time, table and kind."""
    start = F.unix_timestamp(F.window(F.timestamp_seconds("timestamp"), width)["start"])
    return changes.groupBy(start.alias("window_start"), "table_name", "dml_type").agg(F.count(F.lit(1)).alias("changes"))


def changed_columns(changes: DataFrame) -> DataFrame:
    """For updates, the keys whose values differ between the images."""
    kind = "map<string,string>"
    both = changes.filter("dml_type = 'UPDATE'").withColumns({"_b": F.from_json("before_values", kind), "_a": F.from_json("after_values", kind)})
    keys = F.filter(F.map_keys("_a"), lambda k: ~F.element_at("_a", k).eqNullSafe(F.element_at("_b", k)))
    return both.withColumn("changed", F.array_join(F.sort_array(keys), ",")).drop("_a", "_b")


def row_versions(changes: DataFrame, key: str = "c0") -> DataFrame:
    """Numbers the versions of each key in log order."""
    keyed = changes.withColumn("key", F.get_json_object(F.coalesce("after_values", "before_values"), f"$.{key}"))
    order = Window.partitionBy("database", "table_name", "key").orderBy("binlog_file", "log_pos", "event_row_index")
    return keyed.withColumn("version", F.row_number().over(order))
