"""Class-weighted training of a few candidates: multinomial regression by sums over packed windows.

What is fitted and how is what Spark ML's `LogisticRegression` does (features centred and scaled by their weighted deviations inside the
search, L2 penalty on the plain coefficients, L-BFGS), and its model comes back. The windows are neither copied as double
vectors nor read once per candidate: every step of all searches is one pass over the packed table, whose tasks
unpack a few records at a time and send back one row of sums.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import DataFrame, SparkSession

from wearspan.operators.descent import minimise
from wearspan.operators.linear import answer_columns, class_probabilities, of_regression
from wearspan.operators.metrics import confusion, gate_metrics, weighted_log_loss
from wearspan.operators.packed import blocks, merged_moments, pack_windows, unpacked, window_size
from wearspan.operators.scaling import ScalerState
from wearspan.operators.scoring import VECTOR
from wearspan.operators.weights import weight_column
from wearspan.schemas import LABEL
from wearspan.session import ship, written

WEIGHT = "class_weight"


def fit_candidate(
    train: DataFrame,
    state: ScalerState | None,
    weights: dict[int, float],
    reg_param: float,
    max_iter: int,
    flat: str = "windowed_features",
) -> LogisticRegressionModel:
    """Multinomial regression over the scaled windows of a table, packed first; without a `state` they are scaled already."""
    packed = pack_windows(train, len(state.features) if state else 1, values=flat)
    return fit_candidates(written(packed, "packed"), state, weights, (reg_param,), max_iter)[0]


def fit_candidates(
    train: DataFrame, state: ScalerState | None, weights: dict[int, float], reg_params: tuple[float, ...], max_iter: int
) -> list[LogisticRegressionModel]:
    """A model for every penalty, from passes over packed windows that all of them share."""
    size = window_size(train)
    total, squared, counts, mean, spread = _moments(train, state, weights, size)
    classes = len(counts)
    spark = train.sparkSession
    if np.count_nonzero(counts) == 1:  # one class: nothing to search
        intercepts = np.where(counts > 0, np.inf, 0.0)
        return [_model(spark, np.zeros((classes, size)), intercepts, reg, max_iter) for reg in reg_params]
    free = total - squared / total
    std = np.sqrt(np.maximum(spread / free, 0.0)) if free > 0 else np.zeros(size)
    inverse = np.divide(1.0, std, out=np.zeros(size), where=std != 0)
    prior = np.log1p(counts)
    start = np.append(np.zeros(classes * size), prior - prior.mean())

    def plain(point: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Coefficients and intercepts for scaled windows as they are."""
        scaled = point[:-classes].reshape(classes, size) * inverse
        return scaled, point[-classes:] - scaled @ mean

    def evaluate(points: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
        models = [plain(p) for p in points.values()]
        losses, slopes, shifts = _gradients(train, state, weights, size, models)
        found = {}
        for (i, point), loss, slope, shift in zip(points.items(), losses, slopes, shifts, strict=True):
            held = point[:-classes].reshape(classes, size) * inverse**2
            gradient = (slope * inverse - np.outer(shift, inverse * mean)) / total + reg_params[i] * held
            penalty = 0.5 * reg_params[i] * float((point[:-classes] * held.reshape(-1)).sum())
            found[i] = loss / total + penalty, np.append(gradient.reshape(-1), shift / total)
        return found

    models = []
    for reg, point in zip(reg_params, minimise([start] * len(reg_params), evaluate, max_iter), strict=True):
        coefficients, intercepts = plain(point)
        if reg == 0:  # any constant may be added, so the middle is taken
            coefficients = coefficients - coefficients.mean(axis=0)
        models.append(_model(spark, coefficients, intercepts - intercepts.mean(), reg, max_iter))
    return models


def _model(spark: SparkSession, coefficients: np.ndarray, intercepts: np.ndarray, reg_param: float, max_iter: int) -> LogisticRegressionModel:
    """The numbers as a model of Spark ML, with the parameters of its trainer."""
    trainer = LogisticRegression(
        featuresCol=VECTOR, labelCol=LABEL, weightCol=WEIGHT, family="multinomial", regParam=reg_param, maxIter=max_iter, standardization=False
    )
    classes, size = coefficients.shape
    context = spark.sparkContext
    matrix = _py2java(context, DenseMatrix(classes, size, coefficients.reshape(-1, order="F").tolist()))
    made = context._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        trainer.uid, matrix, _py2java(context, DenseVector(intercepts.tolist())), classes, True
    )
    return trainer._copyValues(LogisticRegressionModel(made))


def _summed(packed: DataFrame, schema: str, add: Callable[[Iterator[pa.RecordBatch]], dict[str, list] | None]) -> list:
    """One row of sums from every task that had windows, in the order of the tasks."""
    ship(packed.sparkSession)

    def task(batches):
        sums = add(batches)
        if sums is not None:
            yield pa.RecordBatch.from_pydict({k: pa.array([v]) for k, v in sums.items()})

    rows = packed.select("labels", "starts", "size", "values").mapInArrow(task, schema).collect()
    if not rows:
        raise ValueError("there is no training window")
    return rows


def _windows(batches: Iterator[pa.RecordBatch], state: ScalerState | None, weights: dict[int, float], size: int):
    """Classes, weights and values of windows, some thousand at a time; what no model can learn from is refused."""
    for batch in batches:
        for labels, starts, values in blocks(batch, state):
            if not len(labels):
                continue
            if np.isnan(labels).any() or (labels < 0).any():
                raise ValueError("labels must be whole numbers from 0 on, and none may be missing")
            if not np.isfinite(values).all():
                raise ValueError("values of training windows must be finite")
            weight = np.ones(len(labels))
            for k, w in weights.items():
                weight[labels == k] = w
            yield labels.astype(np.int64), weight, unpacked(starts, values, size)


def _moments(packed: DataFrame, state: ScalerState | None, weights: dict[int, float], size: int) -> tuple:
    """Weight, squared weights, weight of each class, and the weighted mean and squared deviations of each value of a window."""

    def add(batches):
        found, squared, counts = None, 0.0, np.zeros(0)
        for labels, weight, x in _windows(batches, state, weights, size):
            total = weight.sum()
            apart = x - x[0]  # exactly zero where a value is constant
            middle = weight @ apart / total if total else np.zeros(size)
            part = total, x[0] + middle, weight @ (apart - middle) ** 2
            found = part if found is None else merged_moments(found, part)
            squared += weight @ weight
            here = np.bincount(labels, weight, max(len(counts), labels.max() + 1))
            here[: len(counts)] += counts
            counts = here
        if found is None:
            return None
        return {"total": found[0], "squared": squared, "counts": counts, "mean": found[1], "spread": found[2]}

    rows = _summed(packed, "total double, squared double, counts array<double>, mean array<double>, spread array<double>", add)
    found = None
    counts = np.zeros(max(len(r["counts"]) for r in rows))
    for r in rows:
        part = r["total"], np.array(r["mean"]), np.array(r["spread"])
        found = part if found is None else merged_moments(found, part)
        counts[: len(r["counts"])] += r["counts"]
    return found[0], sum(r["squared"] for r in rows), counts, found[1], found[2]


def _gradients(packed: DataFrame, state: ScalerState | None, weights: dict[int, float], size: int, models: list) -> tuple:
    """Sums of loss, slopes of the coefficients and slopes of the intercepts, for each of the models."""
    classes = len(models[0][1])
    coefficients = np.concatenate([c for c, _ in models]).T.copy()
    intercepts = np.concatenate([b for _, b in models])

    def add(batches):
        losses, slopes, shifts = np.zeros(len(models)), np.zeros(coefficients.T.shape), np.zeros(len(intercepts))
        seen = False
        for labels, weight, x in _windows(batches, state, weights, size):
            seen = True
            with np.errstate(all="ignore"):
                margins = (x @ coefficients + intercepts).reshape(len(x), len(models), classes)
                margins -= margins.max(axis=2, keepdims=True)
                powers = np.exp(margins)
                sums = powers.sum(axis=2, keepdims=True)
                at = np.arange(len(x))
                losses += weight @ (np.log(sums[:, :, 0]) - margins[at, :, labels])
                powers /= sums
                powers[at, :, labels] -= 1.0
                powers *= weight[:, None, None]
                pulls = powers.reshape(len(x), -1)
                slopes += pulls.T @ x
                shifts += pulls.sum(axis=0)
        return {"losses": losses, "slopes": slopes.reshape(-1), "shifts": shifts} if seen else None

    rows = _summed(packed, "losses array<double>, slopes array<double>, shifts array<double>", add)
    losses, slopes, shifts = (sum(np.array(r[name]) for r in rows) for name in ("losses", "slopes", "shifts"))
    return losses, slopes.reshape(len(models), classes, size), shifts.reshape(len(models), classes)


def score_packed(packed: DataFrame, model: LogisticRegressionModel, state: ScalerState | None) -> DataFrame:
    """(label, `probabilities`, `predicted`) of every packed window, as `score_windows` answers it."""
    linear = of_regression(model)
    size = model.numFeatures
    ship(packed.sparkSession)

    def scored(batches):
        for batch in batches:
            if any(n != size for n in batch.column(2).to_pylist()):
                raise ValueError(f"the model takes windows of {size} values")
            for labels, starts, values in blocks(batch, state):
                chances = class_probabilities(unpacked(starts, values, size), linear)
                known = pa.array(np.nan_to_num(labels).astype("<i4"), mask=np.isnan(labels))
                yield pa.RecordBatch.from_arrays([known, *answer_columns(chances)], names=[LABEL, "probabilities", "predicted"])

    columns = packed.select("labels", "starts", "size", "values")
    return columns.mapInArrow(scored, f"{LABEL} int, probabilities array<double>, predicted int")


def evaluate(packed: DataFrame, model, state: ScalerState | None) -> DataFrame:
    """Confusion counts of a model over packed windows."""
    return confusion(score_packed(packed, model, state), LABEL, "predicted")


def candidate_history(
    train: DataFrame,
    val: DataFrame,
    state: ScalerState | None,
    weights: dict[int, float],
    reg_params: tuple[float, ...],
    max_iter: int,
    run_id: str,
) -> tuple[list[LogisticRegressionModel], DataFrame]:
    """Fit every candidate and measure it on the validation windows; step = candidate. Both tables hold packed windows."""
    spark = train.sparkSession
    models, rows = fit_candidates(train, state, weights, reg_params, max_iter), []
    for step, (reg_param, model) in enumerate(zip(reg_params, models, strict=True)):
        measured = gate_metrics(evaluate(val, model, state)).first()
        scored = score_packed(train, model, state).withColumn(WEIGHT, weight_column(weights))
        loss = weighted_log_loss(scored, LABEL, "probabilities", WEIGHT).first()["log_loss"]
        rows.append(
            (
                run_id,
                step,
                float(reg_param),
                float(loss),
                measured["accuracy"],
                measured["f2_weighted"],
                measured["critical_recall"],
            )
        )
    history = spark.createDataFrame(
        rows,
        "run_id string, step int, reg_param double, train_loss double, accuracy double, "
        "f2_weighted double, critical_recall double",
    )
    return models, history
