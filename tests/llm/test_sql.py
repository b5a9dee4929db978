"""Queries with an SQL form give the rows that DuckDB gives."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from wearspan.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small_dir, name):
    connection = duckdb.connect()
    for path in Path(small_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    cursor = connection.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    wanted = sorted(cursor.fetchall())
    got = sorted(tuple(r[c] for c in columns) for r in QUERIES[name](spark, small_dir).collect())
    assert got and got == wanted
