from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wearspan.operators.lineage import digests_of_windows, fingerprint, lineage_tags
from wearspan.operators.registry import (
    champions,
    consistent_shapes,
    describe_champions,
    judge_challengers,
)
from wearspan.operators.selection import (
    GateFailed,
    best_checkpoints,
    completed_steps,
    enforce_gate,
    gate_runs,
    patience_counter,
    stop_steps,
)

HISTORY = "run_id string, step int, f2_weighted double, critical_recall double"


@pytest.mark.parametrize(
    ("f2", "recall", "expected"),
    [(0.90, 0.40, False), (0.50, 0.95, False), (0.80, 0.80, True), (0.75, 0.75, True), (None, 0.9, False)],
)
def test_gate_needs_both_thresholds(spark, f2, recall, expected):
    runs = spark.createDataFrame([("r", 0, f2, recall)], HISTORY)
    assert gate_runs(runs, 0.75, 0.75).first()["passes"] is expected


@pytest.mark.parametrize(
    ("steps", "limit", "best"),
    [
        ([(0.826, 0.61), (0.807, 0.86)], 0.75, 1),
        ([(0.80, 0.5), (0.70, 0.9)], 0.99, 0),
        ([(0.80, 0.9), (0.80, 0.8)], 0.75, 0),
        ([(0.10, 0.1)], 0.75, 0),
    ],
)
def test_checkpoint_prefers_the_gate_then_f2_then_the_first(spark, steps, limit, best):
    history = spark.createDataFrame([("r", i, *s) for i, s in enumerate(steps)], HISTORY)
    row = best_checkpoints(history, limit, limit).first()
    assert row["step"] == best
    assert row["critical_recall"] == steps[best][1]


def test_patience_equals_a_plain_loop(spark):
    rng = random.Random(2)
    rows, expected, stops = [], {}, {}
    for run in range(12):
        best, since, stopped = -1.0, 0, None
        for step in range(25):
            f2 = round(rng.random(), 1)
            rows.append((f"r{run}", step, f2, 0.5))
            if f2 > best:
                best, since = f2, 0
            else:
                since += 1
                if since >= 4 and stopped is None:
                    stopped = step
            expected[f"r{run}", step] = since
        stops[f"r{run}"] = stopped
    history = spark.createDataFrame(rows, HISTORY).repartition(5)
    counted = patience_counter(history).collect()
    assert {(r["run_id"], r["step"]): r["since_improved"] for r in counted} == expected
    assert {r["run_id"]: r["stop_step"] for r in stop_steps(history, 4).collect()} == stops
    ran = completed_steps(history, 4).groupBy("run_id").agg(F.max("step").alias("last")).collect()
    assert {r["run_id"]: r["last"] for r in ran} == {
        k: 24 if v is None else v for k, v in stops.items()
    }


PROMOTIONS = "model_name string, version long, run_id string, promoted_at timestamp_ntz"
RUNS = "run_id string, fingerprint string, f2_weighted double"
CHALLENGERS = "model_name string, run_id string, fingerprint string, f2_weighted double, passes boolean"


@pytest.mark.parametrize(
    ("champion", "challenger", "reason"),
    [
        (None, ("same", 0.1), "no_champion"),
        (("same", 0.90), ("same", 0.80), "worse"),
        (("same", 0.80), ("same", 0.85), "not_worse"),
        (("same", 0.80), ("same", 0.80), "not_worse"),
        (("other", 0.99), ("same", 0.50), "other_data"),
        (("same", None), ("same", 0.50), "champion_without_f2"),
        ("no run", ("same", 0.50), "champion_without_run"),
    ],
)
def test_champion_or_challenger(spark, champion, challenger, reason):
    promotions, runs = [], []
    if champion is not None:
        run = None if champion == "no run" else "old"
        promotions = [("m", 3, run, datetime(2024, 1, 2)), ("m", 2, "older", datetime(2024, 1, 1))]
        if run:
            runs = [("old", *champion)]
    judged = judge_challengers(
        spark.createDataFrame([("m", "new", *challenger, True)], CHALLENGERS),
        spark.createDataFrame(promotions, PROMOTIONS),
        spark.createDataFrame(runs, RUNS),
    ).first()
    assert judged["reason"] == reason
    assert judged["replaces"] is (reason != "worse")
    assert judged["outcome"] == ("champion_is_better" if reason == "worse" else "promoted")


def test_failed_gate_is_never_promoted(spark):
    judged = judge_challengers(
        spark.createDataFrame([("m", "new", "x", 0.9, False)], CHALLENGERS),
        spark.createDataFrame([], PROMOTIONS),
        spark.createDataFrame([], RUNS),
    ).first()
    assert judged["outcome"] == "gate_failed"
    with pytest.raises(GateFailed, match="f2_weighted 0.9000"):
        enforce_gate({"run_id": "new", "f2_weighted": 0.9, "critical_recall": 0.1}, 0.75, 0.75)


def test_shapes_and_description(spark):
    shapes = spark.createDataFrame(
        [("a", 30, 5, 4), ("b", 30, 4, 4), ("c", None, None, 4), ("d", -1, 9, 4)],
        "run_id string, window_size int, model_features int, scaler_features int",
    )
    got = {r["run_id"]: (r["window_size"], r["consistent"]) for r in consistent_shapes(shapes, 10).collect()}
    assert got == {"a": (30, False), "b": (30, True), "c": (10, True), "d": (10, True)}
    promotions = spark.createDataFrame(
        [("m", 1, "a", datetime(2024, 1, 1)), ("m", 2, "b", datetime(2024, 1, 2))], PROMOTIONS
    )
    assert champions(promotions).first()["version"] == 2
    names = spark.createDataFrame(
        [("b", 1, "y"), ("b", 0, "x")], "run_id string, position int, feature string"
    )
    row = describe_champions(promotions, shapes, names, 10).first()
    assert (row["model_version"], row["window_size"], row["num_features"], row["feature_names"]) == (
        "2",
        30,
        4,
        ["x", "y"],
    )


def test_a_champion_without_shape_has_the_default_one(spark):
    shapes = spark.createDataFrame([("b", 30, 5, 4)], "run_id string, window_size int, model_features int, scaler_features int")
    promoted = [("m", 1, "a", datetime(2024, 1, 1)), ("broken", 1, "b", datetime(2024, 1, 1)), ("empty", 1, None, datetime(2024, 1, 1))]
    names = spark.createDataFrame([("a", 1, "y"), ("a", 0, "x")], "run_id string, position int, feature string")
    rows = describe_champions(spark.createDataFrame(promoted, PROMOTIONS), shapes, names, 10).collect()
    assert [(r["model_name"], r["window_size"], r["num_features"], r["feature_names"]) for r in rows] == [("m", 10, 2, ["x", "y"])]


def test_fingerprint_is_stable_and_sensitive(spark):
    rows = [(f"E{i % 2}", i, i % 3, [float(i), i + 0.5]) for i in range(20)]
    schema = "engine_id string, window_index long, failure_type int, windowed_features array<float>"

    def of(data=rows, val=0.2, test=0.2, seed=42, parts=3, names=("a", "b")):
        df = spark.createDataFrame(data, schema).repartition(parts)
        return fingerprint(digests_of_windows(df, len(names)), list(names), val, test, seed).first()["fingerprint"]

    base = of()
    assert of(parts=7) == base
    assert of(data=rows[::-1]) == base
    changed = [
        of(val=0.3),
        of(test=0.3),
        of(seed=7),
        of(names=("b", "a")),
        of(data=[(e, i, y, [v * 2 for v in x]) for e, i, y, x in rows]),
        of(data=[(e, i, (y + 1) % 3, x) for e, i, y, x in rows]),
        of(data=rows[:-1]),
        of(data=[*rows, rows[0]]),
        of(data=[(e, 19 - i, y, x) for e, i, y, x in rows]),
    ]
    assert len({base, *changed}) == len(changed) + 1


def test_lineage_falls_back():
    assert lineage_tags() == {
        "code_version": "unknown",
        "code_dirty": "unknown",
        "data_hash": "unknown",
        "data_dir": "",
        "image_tag": "local-dev",
    }
    assert lineage_tags("abc", True)["image_tag"] == "abc"
    assert lineage_tags("abc", True)["code_dirty"] == "true"
