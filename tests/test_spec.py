import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.filters import admitted, binlog_file_number, in_range
from tidemark.spec import CaptureSpec, SpecError, TableRules, file_number

RULED = [
    ((), (), "any_db", "any_table", True),
    (("db1.t1", "db2.t2"), (), "db1", "t1", True),
    (("db1.t1", "db2.t2"), (), "db1", "t2", False),
    ((), ("db1.t1",), "db1", "t1", False),
    ((), ("db1.t1",), "db1", "t2", True),
    ((), ("trash_db.*",), "trash_db", "any_table", False),
    ((), ("trash_db.*",), "other", "any_table", True),
    (("db.*",), (), "db", "x", True),
    (("db.*",), (), "other", "x", False),
    (("*.users",), (), "any", "users", True),
    (("*.users",), (), "any", "orders", False),
    (("test_schema.specific_table",), ("test_schema.*",), "test_schema", "specific_table", True),
    (("test_schema.specific_table",), ("test_schema.*",), "test_schema", "other", False),
    (("test_schema.*",), ("test_schema.error_log",), "test_schema", "error_log", False),
    (("test_schema.*",), ("test_schema.error_log",), "test_schema", "users", True),
    (("*.special_table",), ("some_db.*",), "some_db", "special_table", True),
    (("*.special_table",), ("some_db.*",), "some_db", "other", False),
    (("audit_db.noisy_log",), ("*.noisy_log",), "audit_db", "noisy_log", True),
    (("audit_db.noisy_log",), ("*.noisy_log",), "other", "noisy_log", False),
    (("Db.T",), (), "db", "t", False),
]


@pytest.mark.parametrize("include,exclude,schema,table,expected", RULED)
def test_rules(include, exclude, schema, table, expected):
    assert TableRules(include, exclude).admits(schema, table) is expected


def test_rules_as_predicate(spark):
    for include, exclude in {(r[0], r[1]) for r in RULED}:
        rules = TableRules(include, exclude)
        rows = spark.createDataFrame([(s, t) for i, e, s, t, _ in RULED if (i, e) == (include, exclude)], "s string, t string")
        for r in rows.withColumn("ok", admitted(rules, F.col("s"), F.col("t"))).collect():
            assert r.ok == rules.admits(r.s, r.t)


@pytest.mark.parametrize("bad", ["nodot", "*.*", ".table", "schema.", "my*db.table", "a.b.c", "", "db.t*"])
def test_malformed_patterns(bad):
    with pytest.raises(SpecError):
        TableRules(include=(bad,))


def test_conflict():
    with pytest.raises(SpecError):
        TableRules(("db.table",), ("db.table",))
    TableRules(("db.table",), ("db.*",))


def test_spec_from_file(tmp_path):
    given = {"host": "127.0.0.1", "port": 15010, "user": "dba", "password": "", "database": "dba", "from_binlog_file": "mysql-bin-changelog.202341", "from_binlog_position": 4, "something": 1}
    (tmp_path / "c.json").write_text(json.dumps(given))
    spec = CaptureSpec.load(tmp_path / "c.json", log_level="debug")
    assert (spec.port, spec.from_binlog_file, spec.output_mode, spec.parquet_batch_size, spec.log_level) == (15010, "mysql-bin-changelog.202341", "stdout", 8192, "debug")


@pytest.mark.parametrize(
    "bad",
    [
        {"host": ""}, {"port": 0}, {"from_binlog_file": ""}, {"from_binlog_position": 3}, {"to_binlog_position": 4},
        {"to_binlog_file": "b.000001", "to_binlog_position": 4}, {"to_binlog_file": "b.000000"}, {"to_binlog_file": "nodigits.x"},
        {"include": ["nodot"]}, {"output_mode": "kafka"},
    ],
)
def test_spec_checks(bad):
    with pytest.raises(SpecError):
        CaptureSpec(**{"from_binlog_file": "b.000001"} | bad)


def test_file_numbers(spark):
    names = {"binlog.000012": 12, "a.b.7": 7, "none": None, "x.": None, "x.1a": None}
    assert {n: file_number(n) for n in names} == names
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert dict(df.select("n", binlog_file_number(F.col("n"))).collect()) == names


def test_range_is_numeric_and_exclusive(spark):
    rows = [(f"b.{n}", p, p + 10) for n in (9, 10, 11) for p in (4, 14, 24)]
    df = spark.createDataFrame(rows, "binlog_file string, start_pos long, log_pos long")
    spec = CaptureSpec(from_binlog_file="b.9", from_binlog_position=14, to_binlog_file="b.10", to_binlog_position=24)
    assert sorted((r[0], r[1]) for r in in_range(df, spec).collect()) == [("b.10", 4), ("b.9", 14), ("b.9", 24)]
    spec = CaptureSpec(from_binlog_file="b.9", from_binlog_position=14, to_binlog_position=25)
    assert sorted((r[0], r[1]) for r in in_range(df, spec).collect()) == [("b.9", 14)]
