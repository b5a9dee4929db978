"""Linear class models as tables, scored by an expression.

A model is one row per class: `class`, `intercept` and `weights`, one weight for each value of a flat scaled window. Such a
table can be written by one job or engine and read by another, and tasks receive plain numbers, never a model object.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.functions.scores import argmax, softmax
from wearspan.operators.scaling import ScalerState, scale_batch, scale_flat
from wearspan.operators.scoring import VECTOR, feature_vector
from wearspan.operators.windows import step_column
from wearspan.schemas import CLASS_NAMES, LABEL, LINEAR_MODEL
from wearspan.session import ship


@dataclass(frozen=True)
class LinearModel:
    """Intercept and weights of each class, in class order; None for a class that training did not hold."""

    intercepts: tuple[float | None, ...]
    weights: tuple[tuple[float, ...] | None, ...]

    @classmethod
    def of(cls, table: DataFrame) -> LinearModel:
        rows = {r["class"]: r for r in table.collect()}  # one row per class
        if not rows or not set(rows) <= set(range(len(CLASS_NAMES))):
            raise ValueError(f"a model needs rows of the classes 0 to {len(CLASS_NAMES) - 1}, got {sorted(rows)}")
        if len({len(r["weights"]) for r in rows.values()}) > 1:
            raise ValueError("all classes of a model need equally many weights")
        found = [rows.get(k) for k in range(len(CLASS_NAMES))]
        return cls(
            tuple(r and r["intercept"] for r in found),
            tuple(r and tuple(r["weights"]) for r in found),
        )

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (k, float(b), [float(x) for x in w])
            for k, (b, w) in enumerate(zip(self.intercepts, self.weights, strict=True))
            if w is not None
        ]
        return spark.createDataFrame(rows, LINEAR_MODEL)


def of_regression(model) -> LinearModel:
    """The numbers of a fitted multinomial regression."""
    found = model.coefficientMatrix.toArray()
    missing = (None,) * (len(CLASS_NAMES) - len(found))
    return LinearModel(
        tuple(float(b) for b in model.interceptVector) + missing,
        tuple(tuple(map(float, row)) for row in found) + missing,
    )


def fit_centroids(train: DataFrame, state: ScalerState | None, flat: str = "windowed_features") -> LinearModel:
    """Nearest class mean as a linear model, from one aggregate over the training windows: no steps, no randomness.

    The squared distance of a window to a mean, over the number of values, is up to what all classes share
    -2 (weights * window + intercept). Means are merged map-side and three vectors come back. Without a `state` the windows
    are those of scaled rows.
    """
    vectors = feature_vector(train, state, flat).filter(F.col(LABEL).isin(list(range(len(CLASS_NAMES)))))
    means = vectors.groupBy(LABEL).agg(Summarizer.mean(F.col(VECTOR)).alias("mean")).collect()
    if not means:
        raise ValueError("there is no training window with a class")
    by_class = {r[LABEL]: r["mean"].toArray() for r in means}
    found = [by_class.get(k) for k in range(len(CLASS_NAMES))]
    return LinearModel(
        tuple(None if m is None else float(-(m @ m) / (2 * len(m))) for m in found),
        tuple(None if m is None else tuple(map(float, m / len(m))) for m in found),
    )


def class_scores(scaled: Column, model: LinearModel) -> Column:
    """Scores of the classes that the model has, in class order: products summed over the window in one walk."""
    known = [k for k, w in enumerate(model.weights) if w is not None]
    arrays = {k: F.array(*[F.lit(x) for x in model.weights[k]]) for k in known}
    start = F.struct(F.lit(0).alias("i"), *[F.lit(model.intercepts[k]).alias(f"s{k}") for k in known])
    return F.aggregate(
        scaled,
        start,
        lambda acc, x: F.struct(
            (acc["i"] + 1).alias("i"),
            *[(acc[f"s{k}"] + F.get(arrays[k], acc["i"]) * x).alias(f"s{k}") for k in known],
        ),
        lambda acc: F.array(*[acc[f"s{k}"] for k in known]),
    )


def class_probabilities(scaled: np.ndarray, model: LinearModel) -> np.ndarray:
    """Chances of the fixed classes for scaled windows as an array, 0 where the model has no such class."""
    known = [k for k, w in enumerate(model.weights) if w is not None]
    coefficients = np.array([model.weights[k] for k in known]).T
    with np.errstate(all="ignore"):
        scores = scaled @ coefficients + np.array([model.intercepts[k] for k in known])
        top = scores.max(axis=1, keepdims=True)
        powers = np.exp(scores - top)
        powers /= powers.sum(axis=1, keepdims=True)
    sure = np.isposinf(top[:, 0])  # trained on one class
    if sure.any():
        powers[sure] = np.arange(len(known)) == scores[sure].argmax(axis=1)[:, None]
    found = np.zeros((len(scaled), max(len(CLASS_NAMES), len(model.weights))))
    found[:, known] = powers
    return found


def answer_columns(chances: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """`probabilities` and `predicted`, the lowest class on ties."""
    n, classes = chances.shape
    offsets = pa.array(np.arange(n + 1, dtype="<i4") * classes)
    return pa.ListArray.from_arrays(offsets, pa.array(chances.reshape(-1))), pa.array(chances.argmax(axis=1).astype("<i4"))


def score_window_table(windows: DataFrame, model: LinearModel, state: ScalerState, column: str = "windowed_features") -> DataFrame:
    """Scale and score a column of flat windows, batch by batch as arrays: `probabilities` and `predicted` take its place.

    Every window needs as many values as the model has weights; a missing value counts as 0 once the others are scaled.
    """
    size = len(next(w for w in model.weights if w is not None))
    means, stds = state.arrays()
    kept = [c for c in windows.columns if c != column]
    ship(windows.sparkSession)

    def scored(batches):
        for batch in batches:
            flat = scale_batch(batch, len(kept), means, stds).column(len(kept))
            if flat.null_count or (pc.list_value_length(flat).to_numpy(zero_copy_only=False) != size).any():
                raise ValueError(f"the model takes windows of {size} values")
            values = pc.fill_null(flat.flatten(), 0).to_numpy(zero_copy_only=False).astype("<f8")
            answers = answer_columns(class_probabilities(values.reshape(-1, size), model))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), *answers], names=[*kept, "probabilities", "predicted"])

    typed = windows.select(*kept, F.col(column).cast("array<float>"))
    left = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in windows.select(*kept).schema)
    return typed.mapInArrow(scored, f"{left}, probabilities array<double>, predicted int")


def score_linear(windows: DataFrame, model: LinearModel, state: ScalerState, flat: str) -> DataFrame:
    """Add `probabilities` (array over the fixed classes, 0 where the model has no such class) and `predicted`.

    A window without as many values as the model has weights gets NULL for both; so does one with a missing value.
    """
    width = len(next(w for w in model.weights if w is not None))
    scores = class_scores(scale_flat(F.col(flat), state).cast("array<double>"), model)
    return _answered(windows, F.when(F.size(flat) == width, scores), model)


def score_stepped(windows: DataFrame, model: LinearModel, features: list[str], window: int) -> DataFrame:
    """`score_linear` over the `stepped_windows` of scaled rows; the columns of the values are left out.

    The products are sums of columns, which Spark compiles in pieces, in the order in which `class_scores` adds them.
    """
    columns = [step_column(i, c) for i in range(window) for c in features]
    known = {k: w for k, w in enumerate(model.weights) if w is not None}
    for w in known.values():
        if len(w) != len(columns):
            raise ValueError(f"the model has {len(w)} weights and a window {len(columns)} values")
    scores = [
        reduce(add, (F.col(c).cast("double") * F.lit(x) for c, x in zip(columns, w, strict=True)), F.lit(model.intercepts[k]))
        for k, w in known.items()
    ]
    return _answered(windows, F.array(*scores), model).drop(*columns)


def _answered(windows: DataFrame, scores: Column, model: LinearModel) -> DataFrame:
    known = [k for k, w in enumerate(model.weights) if w is not None]
    # Each step is a column of its own, so that the window is walked once a row.
    scored = windows.withColumn("_scores", scores)
    fitting = scored.withColumn("_known", F.when(~F.exists("_scores", lambda s: s.isNull()), softmax(F.col("_scores"))))
    spread = [F.get("_known", known.index(k)) if k in known else F.lit(0.0) for k in range(len(CLASS_NAMES))]
    whole = fitting.withColumn("probabilities", F.when(F.col("_known").isNotNull(), F.array(*spread)))
    return whole.withColumn("predicted", argmax(F.col("probabilities"))).drop("_scores", "_known")
