"""Packed windows: nothing is lost in packing, and training and scoring over them answer as Spark ML does over whole windows."""

from __future__ import annotations

import numpy as np
import pytest
from helpers import CLEAN, uneven_series, write_fleet
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

import wearspan.operators.training as training
from wearspan.operators.lineage import digests_of_packed, digests_of_series, digests_of_windows
from wearspan.operators.linear import of_regression, score_window_table
from wearspan.operators.packed import pack_windows
from wearspan.operators.scaling import ScalerState, scale_flat
from wearspan.operators.scoring import score_windows
from wearspan.operators.training import fit_candidate, fit_candidates, score_packed
from wearspan.operators.weights import weight_column
from wearspan.operators.windows import indexed_windows
from wearspan.params import JobParams
from wearspan.plans.features import prepare
from wearspan.plans.train import train_and_evaluate
from wearspan.sources.ledger import Ledger

STATE = ScalerState(("a", "b", "c"), (0.2, 1.0, 5.0), (1.5, 2.0, 0.0))
WEIGHTS = {0: 1.0, 1: 2.5, 2: 0.7}
WINDOWS = "engine_id string, window_index int, failure_type int, windowed_features array<float>"
COLUMNS = ["engine_id", "window_index", "failure_type", "_d"]


def series(n=120, engines=3, classes=3, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for e in range(engines):
        steps = np.cumsum(rng.normal(size=(n + 3, 3)), axis=0) * 0.3
        steps[:, 2] = 5.0  # constant in every window
        for i in range(n):
            values = steps[i : i + 4].reshape(-1).astype("f4")
            label = int(np.clip(np.round(values[0] + rng.normal()), 0, classes - 1))
            rows.append((f"e{e}", i, label, values.tolist()))
    return rows


def test_packed_windows_are_the_windows(spark):
    odd = [
        ("z", 0, 1, None),
        ("z", 1, 1, []),
        ("z", 2, None, [1.0] * 5),
        ("z", 3, 1, [float("nan"), None, -0.0, 0.0, 1.0, 2.0]),
        ("z", 4, 1, [0.0, 0.0, 1.0, 2.0, 3.0, 4.0]),
        (None, None, 1, [1.0] * 6),
        (None, None, 1, [1.0] * 6),
    ]
    rows = [*series(40), *odd, *[(e, i + 500, k, v[:9]) for e, i, k, v in series(30, seed=1)]]
    for parts in (1, 4):
        df = spark.createDataFrame(rows, WINDOWS).coalesce(1)
        df = df if parts == 1 else df.repartition(parts, F.rand(3))
        split = df.withColumn("split", F.when(F.col("engine_id") == "e1", "val").otherwise("train"))
        found = []
        for r in pack_windows(split, 3, "window_index", by="split").collect():
            for e, i, k, at in zip(r["engines"], r["positions"], r["labels"], r["starts"], strict=True):
                found.append((e, i, k, str(r["values"][at : at + r["size"]]), "val" if e == "e1" else "train"))
                assert r["part"] == found[-1][-1]
        assert sorted(map(str, found)) == sorted(str((e, i, k, str(v or []), "val" if e == "e1" else "train")) for e, i, k, v in rows)


def test_steps_that_windows_share_lie_there_once(spark):
    df = spark.createDataFrame(series(500, engines=2), WINDOWS).coalesce(1)
    held = pack_windows(df, 3, "window_index").agg(F.sum(F.size("values"))).first()[0]
    assert 2 * 503 * 3 <= held < 1.1 * 2 * 503 * 3


def test_packed_windows_have_the_digests_of_windows(spark):
    df = spark.createDataFrame([(*r[:5], int(r[4] * 3)) for r in uneven_series()], CLEAN)
    table = indexed_windows(df, 7, ["sensor_1", "sensor_2"]).withColumn("windowed_features", F.flatten("readings"))
    packed = digests_of_packed(pack_windows(table, 2, "window_index"), 2).select(COLUMNS)
    from_rows = digests_of_series(df, ["sensor_1", "sensor_2"], 7).select(COLUMNS)
    assert packed.count() == from_rows.count() and packed.exceptAll(from_rows).count() == 0
    odd = spark.createDataFrame(
        [("z", 0, 1, None), ("z", 1, 1, [None, float("nan")]), ("z", 2, None, [1.0] * 5), (None, None, 1, [-0.0, 0.0, 1.0, 1.0])], WINDOWS
    )
    both = [digests_of_packed(pack_windows(odd, 2, "window_index"), 2), digests_of_windows(odd, 2)]
    assert both[0].select(COLUMNS).exceptAll(both[1].select(COLUMNS)).count() == 0


def by_spark_ml(df, reg, max_iter):
    vector = array_to_vector(scale_flat(F.col("windowed_features"), STATE).cast("array<double>"))
    rows = df.select(vector.alias("features"), F.col("failure_type").cast("double"), weight_column(WEIGHTS).alias("w"))
    return LogisticRegression(
        labelCol="failure_type", weightCol="w", family="multinomial", regParam=reg, maxIter=max_iter, standardization=False
    ).fit(rows)


@pytest.mark.parametrize(("classes", "reg", "max_iter"), [(3, 0.01, 10), (3, 0.0, 6), (2, 0.1, 30), (1, 0.1, 5), (3, 0.1, 0)])
def test_the_model_is_that_of_spark_ml(spark, classes, reg, max_iter):
    df = spark.createDataFrame(series(classes=classes), WINDOWS).repartition(2)
    theirs, ours = by_spark_ml(df, reg, max_iter), fit_candidate(df, STATE, WEIGHTS, reg, max_iter)
    np.testing.assert_allclose(ours.coefficientMatrix.toArray(), theirs.coefficientMatrix.toArray(), rtol=1e-7, atol=1e-10)
    np.testing.assert_allclose(ours.interceptVector.toArray(), theirs.interceptVector.toArray(), rtol=1e-7, atol=1e-10)
    assert (ours.numClasses, ours.numFeatures) == (theirs.numClasses, theirs.numFeatures)
    # Theirs keeps its training summary, which does not always go out to tasks.
    wanted = score_windows(df, ours, STATE, "windowed_features")
    plain = score_window_table(df, of_regression(ours), STATE)
    packed = score_packed(pack_windows(df, 3), ours, STATE)
    answers = [
        sorted((r["failure_type"], *(round(p, 7) + 0.0 for p in r["probabilities"]), r["predicted"]) for r in f.collect())
        for f in (wanted, plain, packed)
    ]
    assert answers[0] == answers[1] == answers[2]


def test_all_candidates_share_their_passes(spark, monkeypatch):
    passes = []
    real = training._gradients
    monkeypatch.setattr(training, "_gradients", lambda *a: passes.append(len(a[-1])) or real(*a))
    packed = pack_windows(spark.createDataFrame(series(), WINDOWS), 3).cache()
    alone = [of_regression(fit_candidates(packed, STATE, WEIGHTS, (reg,), 5)[0]) for reg in (0.01, 0.1, 1.0)]
    single = len(passes)
    together = [of_regression(m) for m in fit_candidates(packed, STATE, WEIGHTS, (0.01, 0.1, 1.0), 5)]
    assert len(passes) - single < single / 2 and max(passes) == 3
    for a, b in zip(alone, together, strict=True):
        np.testing.assert_allclose(a.weights, b.weights, rtol=1e-9, atol=1e-12)


@pytest.mark.parametrize("row", [("e", 0, None, [1.0] * 12), ("e", 0, -1, [1.0] * 12), ("e", 0, 1, [float("nan")] * 12), ("e", 0, 1, [1.0] * 9)])
def test_what_no_model_can_learn_from_is_refused(spark, row):
    df = spark.createDataFrame([*series(20), row], WINDOWS)
    with pytest.raises(Exception, match="labels must be|must be finite|windows have 9 to 12"):
        fit_candidate(df, STATE, WEIGHTS, 0.1, 3)


def test_windows_of_another_length_are_not_scored(spark):
    df = spark.createDataFrame(series(20), WINDOWS)
    model = of_regression(fit_candidate(df, STATE, WEIGHTS, 0.1, 3))
    with pytest.raises(Exception, match="windows of 12 values"):
        score_window_table(df.limit(1).withColumn("windowed_features", F.slice("windowed_features", 1, 9)), model, STATE).collect()


def test_two_engines_are_all_of_each_split(spark, tmp_path):
    write_fleet(tmp_path / "train_FD001.txt", (100, 110))
    params = JobParams(f2_threshold=0.0, critical_recall_threshold=0.0, max_iter=3, reg_params=(0.1,))
    prepare(spark, str(tmp_path), params)
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    run = train_and_evaluate(spark, str(tmp_path), ledger, params)
    sizes = {r["name"]: r["value"] for r in ledger.params().collect()}
    assert [sizes[f"{s}_samples"] for s in ("train", "val", "test")] == ["152"] * 3
    assert run["accuracy"] == pytest.approx(
        ledger.metrics().filter("metric = 'best_val_accuracy'").first()["value"]
    )
