"""What a task sorts follows the share of rows it is dealt, not the size of the table."""

from __future__ import annotations

import re

import pytest

from wearspan import session
from wearspan.operators import windows
from wearspan.operators.labeling import drop_duplicate_rows
from wearspan.queries import QUERIES
from wearspan.queries.series import indexed_clean, windows_of_30
from wearspan.session import spread, tasks_for
from wearspan.sources.bindings import labeled, telemetry, with_copies


@pytest.fixture
def small_share(spark):
    spark.conf.set("spark.wearspan.rowsPerTask", "200")
    yield 200
    spark.conf.unset("spark.wearspan.rowsPerTask")


def partitions(df) -> list[int]:
    text = df._jdf.queryExecution().executedPlan().toString()
    return [int(n) for n in re.findall(r"Exchange hashpartitioning\(.*?, (\d+)\)", text)]


def rows_of(spark, small_dir) -> int:
    return spark.read.parquet(f"{small_dir}/lineitem.parquet").count()


def test_partitions_follow_the_rows(spark, small_share):
    assert tasks_for(spark, 100) == 4 and tasks_for(spark, 6_001) == 31
    df = spark.range(1_000)
    assert spread(df, 700, "id") is df
    assert spread(df, 6_000, "id").rdd.getNumPartitions() == 30


@pytest.mark.parametrize(
    "made",
    [
        lambda s, d: telemetry(s, d),
        lambda s, d: labeled(s, d),
        lambda s, d: drop_duplicate_rows(with_copies(labeled(s, d, ("l_orderkey",)))),
        windows_of_30,
    ],
)
def test_every_exchange_of_the_rows_is_dealt_by_their_number(spark, small_dir, small_share, made):
    found = partitions(made(spark, small_dir))
    assert found and min(found) >= rows_of(spark, small_dir) // small_share


def test_the_window_build_is_dealt_by_the_number_of_rows(spark, small_dir, small_share):
    # Its other exchanges hold one row per engine.
    assert max(partitions(indexed_clean(spark, small_dir))) >= rows_of(spark, small_dir) // small_share


def test_long_series_are_dealt_as_well(spark, small_dir, small_share):
    spark.conf.set("spark.wearspan.rowsPerBlock", "150")
    try:
        assert max(partitions(labeled(spark, small_dir))) >= rows_of(spark, small_dir) // small_share
    finally:
        spark.conf.unset("spark.wearspan.rowsPerBlock")


@pytest.fixture
def many_engines(spark, monkeypatch):
    """Every table of engines counts as too large to be broadcast."""
    for module in (session, windows):
        monkeypatch.setattr(module, "BROADCAST_ROWS", 0, raising=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_many_engines_meet_their_rows_without_an_exchange_of_their_own(spark, small_dir, small_share, many_engines):
    text = indexed_clean(spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    by_engine = [int(n) for n in re.findall(r"Exchange hashpartitioning\(global_unit#\d+, (\d+)\)", text)]
    # One exchange of the rows and one of the engines, both dealt by the number of rows.
    assert len(by_engine) == 2 and min(by_engine) >= rows_of(spark, small_dir) // small_share


@pytest.mark.parametrize("rows_per_block", [None, "150"])
def test_many_engines_give_the_same_windows(spark, small_dir, small_share, rows_per_block, request):
    if rows_per_block:
        spark.conf.set("spark.wearspan.rowsPerBlock", rows_per_block)
    try:
        few = sorted(indexed_clean(spark, small_dir).collect())
        request.getfixturevalue("many_engines")
        many = sorted(indexed_clean(spark, small_dir).collect())
    finally:
        spark.conf.unset("spark.wearspan.rowsPerBlock")
    assert few and many == few


def test_rows_are_the_same(spark, small_dir, small_share):
    names = ["agg_16_engine_digests", "win_4_dense_window_index", "set_2_distinct_rows"]
    dealt = {n: sorted(QUERIES[n](spark, small_dir).collect()) for n in names}
    spark.conf.unset("spark.wearspan.rowsPerTask")
    assert dealt == {n: sorted(QUERIES[n](spark, small_dir).collect()) for n in names}
