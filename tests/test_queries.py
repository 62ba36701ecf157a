import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__
from tidemark.plans import queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{DATA}/{name}')")
    return con


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_against_sql(spark, sql, name):
    got = queries.QUERIES[name](spark, DATA).toPandas()
    want = sql.sql(queries.ORACLE_SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    tidy = lambda df: df[columns].sort_values(columns).reset_index(drop=True).pipe(lambda d: d.where(d.notna(), None))
    pd.testing.assert_frame_equal(tidy(got), tidy(want), check_dtype=False)


def test_int_roundtrip_of_keys_beyond_their_bytes(spark, tmp_path):
    lines = [(key, 1 + n, part, supplier) for n, (key, part, supplier) in enumerate([(8_418_607, 1, 1), (8_418_608, 1 << 40, 5), (9_000_000, (1 << 48) - 1, (1 << 32) - 1), (-8_358_608, 0, 0), (-8_358_609, 2, 3), (1 << 40, 5, 5), (None, None, None)])]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = queries.int_roundtrip(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{tmp_path}/lineitem.parquet/*.parquet')")
    want = con.sql(queries.ORACLE_SQL["int_roundtrip"])
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=lambda r: r[1]) == sorted(want.fetchall(), key=lambda r: r[1])


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 1500
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
