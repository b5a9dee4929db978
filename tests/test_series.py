from __future__ import annotations

import pytest
from helpers import CLEAN, brute_windows, collected_windows, origin_rows, uneven_series
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wearspan.operators.blocks import BLOCK, HALO, SplitPolicy, plan_blocks, route
from wearspan.operators.labeling import drop_duplicate_rows, label_telemetry
from wearspan.operators.ordinals import running_offsets, series_bounds, series_ordinal
from wearspan.operators.windows import (
    indexed_windows,
    require_windows,
    sliding_windows,
    window_counts,
)

TINY = SplitPolicy(rows_per_block=40, max_split_entities=1000, cells_per_block=4)
FEATURES = ["sensor_1", "sensor_2"]


def test_windows_stay_inside_an_engine(spark):
    df = spark.createDataFrame(origin_rows(), CLEAN)
    rows = sliding_windows(df, 3, ["sensor_1"]).collect()
    assert len(rows) == 4 + 5 + 7
    for row in rows:
        values = [step[0] for step in row["readings"]]
        assert values == sorted(values)
        number = ("left", "mid", "right").index(row["engine_id"]) + 1
        assert {int(v // 10_000) for v in values} == {number}


def test_input_order_does_not_matter(spark):
    rows = origin_rows()
    forward = sliding_windows(spark.createDataFrame(rows, CLEAN), 3, ["sensor_1"])
    backward = sliding_windows(
        spark.createDataFrame(rows[::-1], CLEAN).repartition(3), 3, ["sensor_1"]
    )
    assert collected_windows(forward) == collected_windows(backward)


def test_label_is_the_last_rows(spark):
    rows = [(1, c, "x", float(c), 0.0, c % 3) for c in range(1, 8)]
    got = sliding_windows(spark.createDataFrame(rows, CLEAN), 4, ["sensor_1"]).collect()
    assert {r["end_cycle"]: r["failure_type"] for r in got} == {c: c % 3 for c in range(4, 8)}


def test_short_engines_give_nothing_and_none_at_all_is_an_error(spark):
    rows = [*origin_rows(), (9, 1, "short", 1.0, 1.0, 0), (9, 2, "short", 1.0, 1.0, 0)]
    windows = sliding_windows(spark.createDataFrame(rows, CLEAN), 3, FEATURES)
    assert "short" not in {r["engine_id"] for r in windows.collect()}
    with pytest.raises(ValueError, match="at least 50"):
        require_windows(sliding_windows(spark.createDataFrame(rows, CLEAN), 50, FEATURES), 50)


@pytest.mark.parametrize("window", [1, 2, 7, 30])
def test_split_series_equal_brute_force(spark, window):
    rows = uneven_series()
    df = spark.createDataFrame(rows, CLEAN).repartition(5)
    plan = plan_blocks(df, "global_unit", "time_in_cycles", halo=window - 1, policy=TINY)
    assert plan.long_series.count() >= 2
    got = collected_windows(sliding_windows(df, window, FEATURES, plan=plan))
    assert got == brute_windows(rows, window)


@pytest.mark.parametrize("window", [5, 30])
def test_plan_from_raw_rows_holds_after_deduplication(spark, window):
    rows = uneven_series()
    raw = spark.createDataFrame(rows, CLEAN)
    plan = plan_blocks(raw, "global_unit", "time_in_cycles", halo=window - 1, policy=TINY)
    got = collected_windows(
        sliding_windows(drop_duplicate_rows(raw), window, FEATURES, plan=plan)
    )
    assert got == brute_windows(sorted(set(rows)), window)


def test_a_hot_series_is_spread_over_blocks(spark):
    df = spark.createDataFrame(uneven_series(), CLEAN)
    plan = plan_blocks(df, "global_unit", "time_in_cycles", halo=4, policy=TINY)
    routed = route(df, plan, with_halo=True)
    sizes = {
        (r["global_unit"], r[BLOCK]): r["count"]
        for r in routed.groupBy("global_unit", BLOCK).count().collect()
    }
    hot = [n for (name, _), n in sizes.items() if name == "hot"]
    assert len(hot) >= 5
    assert max(hot) < 150
    assert routed.filter(f"NOT {HALO}").count() == df.count()


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    gaps=st.lists(st.sampled_from([0, 1, 1, 2, 30, 1000]), min_size=1, max_size=120),
    window=st.integers(1, 12),
    limit=st.integers(2, 25),
)
def test_any_spacing_of_cycles(spark, gaps, window, limit):
    cycle, rows = 1, []
    for i, gap in enumerate(gaps):
        cycle += gap
        rows.append((1, cycle, "x", float(i), 0.0, i % 3))
    policy = SplitPolicy(rows_per_block=limit, max_split_entities=1000, cells_per_block=3)
    df = spark.createDataFrame(rows, CLEAN)
    assert collected_windows(sliding_windows(df, window, FEATURES, policy=policy)) == brute_windows(
        rows, window
    )


def test_ordinals_of_split_series(spark):
    rows = [(1, i * 3 + (i % 2), "hot", float(i), 0.0, 0) for i in range(500)] + origin_rows()
    df = spark.createDataFrame(rows, CLEAN).repartition(7)
    got = series_ordinal(df, "global_unit", ["time_in_cycles", "sensor_1"], "pos", TINY).collect()
    expected = {}
    for name in {r[2] for r in rows}:
        ordered = sorted((r for r in rows if r[2] == name), key=lambda r: (r[1], r[3]))
        expected.update({(name, r[1], r[3]): i + 1 for i, r in enumerate(ordered)})
    assert {(r["global_unit"], r["time_in_cycles"], r["sensor_1"]): r["pos"] for r in got} == expected


def test_labels_of_split_series_equal_unsplit_ones(spark):
    df = spark.createDataFrame(uneven_series(), CLEAN).drop("failure_type")
    key = ["global_unit", "time_in_cycles", "sensor_1", "sensor_2", "RUL", "failure_type"]
    whole = sorted(map(tuple, label_telemetry(df).select(key).collect()))
    split = sorted(map(tuple, label_telemetry(df, policy=TINY).select(key).collect()))
    assert whole == split


def test_global_index_is_dense_and_follows_engine_order(spark):
    rows = sorted(set(uneven_series()))
    df = spark.createDataFrame(rows, CLEAN)
    for policy in (None, TINY):
        got = indexed_windows(df, 5, FEATURES, policy).collect()
        got.sort(key=lambda r: r["global_index"])
        assert [r["global_index"] for r in got] == list(range(len(got)))
        assert [r["engine_id"] for r in got] == sorted(r["engine_id"] for r in got)
        per_engine = {}
        for r in got:
            per_engine.setdefault(r["engine_id"], []).append(r["window_index"])
        assert all(v == list(range(len(v))) for v in per_engine.values())
        flat = [
            (r["engine_id"], r["end_cycle"], r["failure_type"], tuple(x for s in r["readings"] for x in s))
            for r in got
        ]
        assert sorted(flat) == brute_windows(rows, 5)


def test_window_counts_need_no_windows(spark):
    df = spark.createDataFrame(origin_rows(cycles=5), CLEAN)
    assert {r["global_unit"]: r["windows"] for r in window_counts(df, 3).collect()} == {
        "left": 3,
        "mid": 4,
        "right": 6,
    }
    assert all(r["windows"] == 0 for r in window_counts(df, 9).collect())


def test_offsets_and_bounds(spark):
    sizes = spark.createDataFrame([(f"e{i:04d}", i % 5) for i in range(300)], "k string, n long")
    got = {r["k"]: r["offset"] for r in running_offsets(sizes, "k", "n").collect()}
    total = 0
    for i in range(300):
        assert got[f"e{i:04d}"] == total
        total += i % 5
    df = spark.createDataFrame(origin_rows(), CLEAN)
    found = sorted(map(tuple, series_bounds(df, "global_unit", ["time_in_cycles"]).collect()))
    assert found == [("left", 1, 6), ("mid", 7, 13), ("right", 14, 22)]
