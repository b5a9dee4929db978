"""Scaling before windowing, and windows whose values are columns, against the plain forms."""

from __future__ import annotations

import pytest
from helpers import CLEAN, brute_windows, uneven_series
from pyspark.sql import functions as F

from wearspan.operators.blocks import SplitPolicy
from wearspan.operators.linear import LinearModel, fit_centroids, score_linear, score_stepped
from wearspan.operators.scaling import ScalerState, fit_scaler, scale_rows, scale_rows_lazily
from wearspan.operators.windows import sliding_windows, step_column, stepped_windows
from wearspan.queries import QUERIES

FEATURES = ["sensor_1", "sensor_2"]


def frame(spark):
    # One label per key, because rows of equal keys may come in either order.
    return spark.createDataFrame([(*r[:5], int(r[4] * 3)) for r in uneven_series()], CLEAN)


@pytest.mark.parametrize("window", [1, 7])
@pytest.mark.parametrize("limit", [40, 10**6])
def test_stepped_windows_hold_all_values_of_all_windows(spark, window, limit):
    rows = frame(spark)
    floats = rows.withColumns({c: F.col(c).cast("float") for c in FEATURES})
    got = stepped_windows(floats, window, FEATURES, SplitPolicy(rows_per_block=limit))
    names = [step_column(i, c) for i in range(window) for c in FEATURES]
    plain = brute_windows([tuple(r) for r in rows.collect()], window)
    assert sorted((r["engine_id"], r["end_cycle"], r["failure_type"], tuple(r[n] for n in names)) for r in got.collect()) == plain


def test_both_ways_of_scoring_give_the_same_answers(spark):
    rows = frame(spark)
    state = ScalerState.of(fit_scaler(rows, FEATURES, 7))
    windows = sliding_windows(rows, 7, FEATURES).withColumn("flat", F.flatten("readings"))
    model = fit_centroids(windows, state, "flat")
    scaled = scale_rows(rows, state)
    again = fit_centroids(sliding_windows(scaled, 7, FEATURES).withColumn("flat", F.flatten("readings")), None, "flat")
    for a, b in zip(model.weights, again.weights, strict=True):
        assert a == pytest.approx(b)

    def answers(df):
        return sorted((r["engine_id"], r["end_cycle"], r["predicted"], list(r["probabilities"])) for r in df.collect())

    first, second = answers(score_linear(windows, model, state, "flat")), answers(score_stepped(stepped_windows(scaled, 7, FEATURES), model, FEATURES, 7))
    assert len(first) > 500
    assert first == second
    with pytest.raises(ValueError, match="weights"):
        score_stepped(windows, LinearModel((0.0, None, None), ((1.0,), None, None)), FEATURES, 7)


def test_lazy_scaler_gives_the_same_floats(spark):
    rows = frame(spark)
    scaler = fit_scaler(rows, FEATURES, 7)
    lazy, literal = scale_rows_lazily(rows, scaler), scale_rows(rows, ScalerState.of(scaler))
    assert lazy.columns == literal.columns
    assert lazy.exceptAll(literal).count() == literal.exceptAll(lazy).count() == 0


def test_both_forms_of_a_window_meet_without_a_join(spark, small_dir):
    text = QUERIES["dst_6_scale_then_window"](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text


def test_rows_and_not_windows_are_scaled(spark, small_dir):
    text = QUERIES["jn_4_scaled_windows"](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" in text and "transform(" not in text
