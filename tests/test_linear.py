"""Linear models as tables: class means and scores against plain Python."""

from __future__ import annotations

import math
import random

import pytest

from wearspan.operators.linear import LinearModel, fit_centroids, score_linear
from wearspan.operators.scaling import ScalerState

STATE = ScalerState(("x", "y"), (1.0, 0.0), (2.0, 0.0))
WINDOWS = "engine_id string, failure_type int, flat array<float>"


def made(n=60, classes=(0, 1, 2)):
    rng = random.Random(5)
    return [(f"e{i % 4}", k := rng.choice(classes), [rng.randint(-8, 8) / 4 + k for _ in range(6)]) for i in range(n)]


def scaled(values):
    return [(v - 1) / 2 if i % 2 == 0 else v for i, v in enumerate(values)]


def plain(rows):
    means = {}
    for k in {r[1] for r in rows}:
        mine = [scaled(r[2]) for r in rows if r[1] == k]
        means[k] = [sum(c) / len(mine) for c in zip(*mine, strict=True)]
    return means


def chances(values, means):
    near = {k: -sum((a - b) ** 2 for a, b in zip(scaled(values), m, strict=True)) / 12 for k, m in means.items()}
    total = sum(map(math.exp, near.values()))
    return [math.exp(near[k]) / total if k in near else 0.0 for k in range(3)]


@pytest.mark.parametrize("classes", [(0, 1, 2), (0, 2), (1,)])
def test_nearest_mean_as_a_linear_model(spark, classes):
    rows = made(classes=classes)
    df = spark.createDataFrame(rows, WINDOWS)
    # Rows without a class, or with one outside the domain, teach nothing.
    model = fit_centroids(df.unionByName(spark.createDataFrame([("z", None, [9.0] * 6), ("z", 7, [9.0] * 6)], WINDOWS)), STATE, "flat")
    assert LinearModel.of(model.table(spark)) == model
    means = plain(rows)
    for k in range(3):
        assert model.weights[k] is None if k not in means else [6 * w for w in model.weights[k]] == pytest.approx(means[k])
    for r in score_linear(df, model, STATE, "flat").collect():
        wanted = chances(r["flat"], means)
        assert list(r["probabilities"]) == pytest.approx(wanted)
        assert wanted[r["predicted"]] == pytest.approx(max(wanted))


def test_windows_that_do_not_fit_have_no_answer(spark):
    model = fit_centroids(spark.createDataFrame(made(), WINDOWS), STATE, "flat")
    odd = [("a", 0, [1.0] * 5), ("b", 0, None), ("c", 0, []), ("d", 0, [1.0, None, 1.0, 1.0, 1.0, 1.0])]
    out = score_linear(spark.createDataFrame(odd, WINDOWS), model, STATE, "flat").collect()
    assert [(r["probabilities"], r["predicted"]) for r in out] == [(None, None)] * 4


def test_broken_models_are_refused(spark):
    with pytest.raises(ValueError, match="no training window"):
        fit_centroids(spark.createDataFrame([], WINDOWS), STATE, "flat")
    table = LinearModel((0.0, 0.0, None), ((1.0,), (1.0, 2.0), None)).table(spark)
    with pytest.raises(ValueError, match="equally many"):
        LinearModel.of(table)
    with pytest.raises(ValueError, match="needs rows"):
        LinearModel.of(table.limit(0))
