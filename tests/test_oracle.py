"""Every query with a SQL form gives the rows DuckDB gives."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from wearspan.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def oracle(small_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in Path(small_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)

    def value(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v

    return sorted((tuple(value(row[i]) for i in order) for row in rows), key=repr)


BANNED = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "MapInPandas",
    "FlatMapGroups",
)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, oracle, small_dir, name):
    df = QUERIES[name](spark, small_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [b for b in BANNED if b in plan] == []
    cursor = oracle.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    got = comparable(df.columns, map(tuple, df.collect()))
    assert got
    assert got == comparable(columns, cursor.fetchall())


def test_entry_points(spark):
    assert driver.entry(spark).count() == 12
    assert set(driver.oracle_sql()) <= set(driver.queries())
