"""Every query on the smallest tables against the SQL that states it."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.compare import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    got = frame.collect()
    if name not in ORACLES:
        assert got
        return
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert rows_of(frame.columns, got) == rows_of(columns, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["traj_id", "step_id", "items"]
