"""Scoring of window tables and requests."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearspan.functions.scores import argmax, class_name, probability_map
from wearspan.operators.contracts import SCORING_REQUEST, VIOLATIONS, Checked, check, request_shape
from wearspan.operators.scaling import ScalerState, scale_flat
from wearspan.schemas import CLASS_NAMES, CORRUPT_COLUMN, CRITICAL

VECTOR = "features"


def feature_vector(windows: DataFrame, state: ScalerState | None, flat: str) -> DataFrame:
    """Scaled flat window as the vector a Spark ML model takes; without a `state` the windows are scaled already."""
    scaled = F.col(flat) if state is None else scale_flat(F.col(flat), state)
    return windows.withColumn(VECTOR, array_to_vector(scaled.cast("array<double>")))


def score_windows(windows: DataFrame, model, state: ScalerState | None, flat: str) -> DataFrame:
    """Add `probabilities` (array over the fixed classes) and `predicted` (class index).

    Only the probability column is asked of the model, and it is read once: the model is one call
    per row. Classes above the highest one in training get 0.
    """
    quiet = model.copy().setRawPredictionCol("").setPredictionCol("")
    scored = quiet.transform(feature_vector(windows, state, flat))
    probabilities = vector_to_array("probability")
    missing = len(CLASS_NAMES) - model.numClasses
    if missing > 0:
        probabilities = F.concat(probabilities, F.array(*[F.lit(0.0)] * missing))
    return (
        scored.withColumn("probabilities", probabilities)
        .withColumn("predicted", argmax(F.col("probabilities")))
        .drop(VECTOR, "probability")
    )


def responses(scored: DataFrame, version: str | Column) -> DataFrame:
    """Answer rows: engine, class name, rounded probability per class and model version."""
    version = version if isinstance(version, Column) else F.lit(str(version))
    return scored.select(
        "engine_id",
        class_name(F.col("predicted")).alias("prediction"),
        probability_map(F.col("probabilities")).alias("probabilities"),
        version.alias("model_version"),
    )


def audit_rows(answers: DataFrame) -> DataFrame:
    """One audit record per served prediction."""
    return answers.select("engine_id", "prediction", "model_version")


def critical_above(answers: DataFrame, limit: float) -> DataFrame:
    """Answers whose critical probability is above the caller's own limit."""
    return answers.filter(F.col("probabilities")[CLASS_NAMES[CRITICAL]] > limit)


def request_columns(requests: DataFrame) -> list[str]:
    """Everything a request holds: its fields and, where it was read from text, the text that was no request."""
    return [c for c in ("engine_id", "readings", CORRUPT_COLUMN) if c in requests.columns]


def checked_requests(
    requests: DataFrame, window: int | Column | None = None, features: int | Column | None = None
) -> Checked:
    """Requests with their violations; the shape is checked when a model is known.

    Text that was no request has one violation, `well_formed`, in place of those of its missing fields.
    """
    contract = SCORING_REQUEST
    if window is not None:
        contract = contract.with_row_check(*request_shape(window, features))
    checked = check(requests, contract)
    if CORRUPT_COLUMN not in requests.columns:
        return checked
    malformed = F.col(CORRUPT_COLUMN).isNotNull()
    tests = [(name, malformed | F.coalesce(good, F.lit(False))) for name, good in checked.tests]
    return replace(checked, tests=(*tests, ("well_formed", ~malformed)))


def accepted_and_rejected(
    requests: DataFrame, window: int, features: int
) -> tuple[DataFrame, DataFrame]:
    checked = checked_requests(requests, window, features)
    return checked.good(), checked.bad().withColumn("reasons", F.array_join(VIOLATIONS, ","))


def named_readings(requests: DataFrame, manifest: DataFrame) -> DataFrame:
    """Readings in long form with feature names bound by position.

    The manifest has one row per feature, so its size is fixed by the table width.
    """
    steps = requests.select("engine_id", F.posexplode("readings").alias("step", "_row"))
    values = steps.select("engine_id", "step", F.posexplode("_row").alias("position", "value"))
    return values.join(F.broadcast(manifest), "position")
