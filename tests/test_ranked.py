"""Series cut by rank: even blocks and exact rows for any keys."""

from __future__ import annotations

import pytest
from helpers import CLEAN, brute_windows, collected_windows, uneven_series
from pyspark.sql import functions as F

from wearspan.operators.blocks import BLOCK, HALO, SplitPolicy
from wearspan.operators.labeling import label_telemetry
from wearspan.operators.ordinals import series_ordinal
from wearspan.operators.ranked import RANK, find_long_series, split_by_rank
from wearspan.operators.windows import indexed_windows, sliding_windows

FEATURES = ["sensor_1", "sensor_2"]
ORDER = ["time_in_cycles", *FEATURES]
LIMIT = 40
POLICY = SplitPolicy(rows_per_block=LIMIT)


def series(kind):
    """Rows of one hard series among small ones."""
    small = [(1, i, "b", float(i), 0.0, 0) for i in range(1, 20)]
    if kind == "outlier":
        hard = [(1, i, "hot", float(i % 7), i / 3, i % 3) for i in range(1, 300)] + [(1, 10**15, "hot", 1.0, 2.0, 2)]
    elif kind == "equal cycles":
        hard = [(1, 5, "hot", float(i), float(i % 11), 1) for i in range(300)]
    elif kind == "equal rows":
        hard = [(1, 5, "hot", 1.0, 2.0, 1)] * 300
    elif kind == "bursts":
        hard = [(1, 1000 * (i // 90), "hot", float(i % 90), 0.5, 0) for i in range(300)]
    elif kind == "missing engine":
        hard = [(1, i, None, float(i), 0.0, 0) for i in range(300)]
    else:
        return uneven_series()
    return small + hard


KINDS = ["outlier", "equal cycles", "equal rows", "bursts", "missing engine", "uneven"]


@pytest.mark.parametrize("halo", [0, 6, 95])
@pytest.mark.parametrize("kind", KINDS)
def test_no_block_is_above_the_limit(spark, kind, halo):
    df = spark.createDataFrame(series(kind), CLEAN).repartition(5)
    split = split_by_rank(df, "global_unit", ORDER, halo, POLICY)
    assert split.keys == ["global_unit", BLOCK]
    own = split.rows.filter(f"NOT {HALO}").groupBy("global_unit", BLOCK).count().collect()
    assert max(r["count"] for r in own) == LIMIT and sum(r["count"] for r in own) == df.count()
    copies = split.rows.filter(HALO).groupBy("global_unit", BLOCK).count().collect()
    assert all(r["count"] == min(halo, r[BLOCK] * LIMIT) for r in copies)
    ranks = split.rows.filter(f"{RANK} IS NOT NULL AND NOT {HALO}").groupBy("global_unit").agg(F.sort_array(F.collect_list(RANK)).alias("r")).collect()
    assert all(r["r"] == list(range(1, len(r["r"]) + 1)) for r in ranks) and ranks


@pytest.mark.parametrize("window", [1, 7, 90])
@pytest.mark.parametrize("kind", [k for k in KINDS if k != "missing engine"])
def test_windows_equal_plain_python(spark, kind, window):
    rows = series(kind)
    df = spark.createDataFrame(rows, CLEAN).repartition(3)
    got = collected_windows(sliding_windows(df, window, FEATURES, policy=POLICY))
    want = brute_windows(rows, window)
    if kind == "uneven":  # equal readings may carry different labels there
        got, want = [(e, c, v) for e, c, _, v in got], [(e, c, v) for e, c, _, v in want]
        got, want = sorted(got), sorted(want)
    assert got == want


@pytest.mark.parametrize("kind", KINDS)
def test_positions_and_labels_equal_uncut_ones(spark, kind):
    df = spark.createDataFrame(series(kind), CLEAN)
    cut = series_ordinal(df, "global_unit", ORDER, "pos", POLICY).select("global_unit", *ORDER, "pos")
    whole = series_ordinal(df, "global_unit", ORDER, "pos").select("global_unit", *ORDER, "pos")
    assert sorted(map(repr, cut.collect())) == sorted(map(repr, whole.collect()))
    raw = df.drop("failure_type")
    columns = [*raw.columns, "RUL", "failure_type"]
    labels = [sorted(map(repr, label_telemetry(raw, policy=p).select(columns).collect())) for p in (POLICY, None)]
    assert labels[0] == labels[1]


def test_indexes_are_dense_over_cut_engines(spark):
    df = spark.createDataFrame(series("bursts"), CLEAN)
    rows = indexed_windows(df, 7, FEATURES, POLICY).select("engine_id", "window_index", "global_index").collect()
    assert sorted(r["global_index"] for r in rows) == list(range(len(rows)))
    hot = sorted((r["global_index"], r["window_index"]) for r in rows if r["engine_id"] == "hot")
    assert [w for _, w in hot] == list(range(294))


def test_short_series_are_left_alone(spark):
    df = spark.createDataFrame(series("bursts"), CLEAN)
    assert find_long_series(df, "global_unit", "time_in_cycles").table is None
    split = split_by_rank(df, "global_unit", ORDER)
    assert split.keys == ["global_unit"] and split.order == ORDER
    assert split_by_rank(df.limit(0), "global_unit", ORDER, policy=POLICY).rows.count() == 0
