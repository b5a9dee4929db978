from __future__ import annotations

import numpy as np
import pytest
from helpers import CLEAN, brute_windows, uneven_series
from pyspark.sql import functions as F

from wearspan.operators.blocks import SplitPolicy
from wearspan.operators.scaling import (
    ScalerState,
    fit_scaler,
    scale_flat,
    scale_readings,
    scale_table,
    window_weight,
)
from wearspan.operators.weights import class_weights, majority_class
from wearspan.plans.train import window_scaler

FEATURES = ["sensor_1", "sensor_2"]


def exploded(rows, window, engines=None):
    values = [
        w[3] for w in brute_windows(rows, window) if engines is None or w[0] in engines
    ]
    flat = np.array(values, dtype=np.float64).reshape(-1, 2)
    return flat.mean(axis=0), flat.std(axis=0), len(flat)


@pytest.mark.parametrize("window", [1, 2, 5, 30, 61])
def test_closed_form_equals_exploded_windows(spark, window):
    rows = uneven_series()
    state = fit_scaler(spark.createDataFrame(rows, CLEAN).repartition(4), FEATURES, window).collect()
    mean, std, n = exploded(rows, window)
    assert [r["feature"] for r in state] == FEATURES
    np.testing.assert_allclose([r["mean"] for r in state], mean, rtol=1e-12)
    np.testing.assert_allclose([r["std"] for r in state], std, rtol=1e-10)
    assert {r["n"] for r in state} == {n}


@pytest.mark.parametrize("window", [2, 30])
def test_cut_series_give_the_same_state(spark, window):
    rows = uneven_series()
    df = spark.createDataFrame(rows, CLEAN).repartition(4)
    state = fit_scaler(df, FEATURES, window, policy=SplitPolicy(rows_per_block=35)).collect()
    mean, std, n = exploded(rows, window)
    np.testing.assert_allclose([r["mean"] for r in state], mean, rtol=1e-12)
    np.testing.assert_allclose([r["std"] for r in state], std, rtol=1e-10)
    assert {r["n"] for r in state} == {n}


def test_large_means_keep_their_spread(spark):
    rows = [(1, c, "x", 1e6 + (c % 7), 1.0, 0) for c in range(1, 200)]
    state = fit_scaler(spark.createDataFrame(rows, CLEAN), FEATURES, 30).collect()
    _, std, _ = exploded(rows, 30)
    np.testing.assert_allclose(state[0]["std"], std[0], rtol=1e-9)
    assert state[1]["std"] == 0.0


def test_only_training_engines_count(spark):
    rows = uneven_series()
    df = spark.createDataFrame(rows, CLEAN)
    train = spark.createDataFrame([("b",), ("f",)], "global_unit string")
    state = fit_scaler(df, FEATURES, 5, train).collect()
    mean, std, n = exploded(rows, 5, {"b", "f"})
    np.testing.assert_allclose([r["mean"] for r in state], mean, rtol=1e-12)
    np.testing.assert_allclose([r["std"] for r in state], std, rtol=1e-10)
    assert state[0]["n"] == n


def test_no_long_enough_training_engine(spark):
    with pytest.raises(ValueError, match="no training engine"):
        fit_scaler(spark.createDataFrame(uneven_series()[:3], CLEAN), FEATURES, 30)


def test_weights_count_windows_per_row(spark):
    for n, window in [(10, 3), (5, 5), (4, 5), (12, 9)]:
        got = [
            r[0]
            for r in spark.range(n).orderBy("id").select(window_weight(F.col("id"), F.lit(n), window)).collect()
        ]
        expected = [sum(s <= i < s + window for s in range(n - window + 1)) for i in range(n)]
        assert got == expected


def test_window_table_scaler_equals_numpy(spark):
    rows = brute_windows(uneven_series(), 5)
    df = spark.createDataFrame([(list(r[3]),) for r in rows], "windowed_features array<float>")
    state = window_scaler(df, FEATURES).collect()
    mean, std, n = exploded(uneven_series(), 5)
    np.testing.assert_allclose([r["mean"] for r in state], mean, rtol=1e-9)
    np.testing.assert_allclose([r["std"] for r in state], std, rtol=1e-9)
    assert state[0]["n"] == n


def test_scaling_keeps_shape_and_narrows_last(spark):
    state = ScalerState(("a", "b"), (10.0, 20.0), (0.0, 2.0))
    df = spark.createDataFrame(
        [([[10.0, 20.0], [1000.0, 1000.0]],)], "readings array<array<double>>"
    )
    row = df.select(
        scale_readings(F.col("readings"), state).alias("r"),
        scale_flat(F.flatten("readings"), state).alias("f"),
    )
    assert dict(row.dtypes) == {"r": "array<array<float>>", "f": "array<float>"}
    first = row.first()
    assert first["r"] == [[0.0, 0.0], [990.0, 490.0]]
    assert first["f"] == [0.0, 0.0, 990.0, 490.0]
    table = spark.createDataFrame(
        [(0, "a", 10.0, 0.0), (1, "b", 20.0, 2.0)], "position int, feature string, mean double, std double"
    )
    flat = df.select(F.flatten("readings").alias("windowed_features"))
    assert scale_table(flat, table).first()[0] == first["f"]


def test_class_weights_are_balanced_and_absent_ones_neutral(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(2,)] * 2, "failure_type int")
    got = {r["class"]: (r["rows"], r["weight"]) for r in class_weights(df).collect()}
    assert got == {0: (6, 8 / (2 * 6)), 1: (0, 1.0), 2: (2, 8 / (2 * 2))}
    assert majority_class(df).first()[0] == 0
    tied = spark.createDataFrame([(2,), (1,), (1,), (2,)], "failure_type int")
    assert majority_class(tied).first()[0] == 1
