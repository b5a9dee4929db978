"""Expressions over class scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wearspan.schemas import CLASS_NAMES


def softmax(scores: Column) -> Column:
    """Probabilities from scores; the maximum is subtracted first to keep exp() in range."""
    powers = F.transform(scores, lambda s: F.exp(s - F.array_max(scores)))
    total = F.aggregate(powers, F.lit(0.0), lambda acc, p: acc + p)
    return F.transform(powers, lambda p: p / total)


def argmax(values: Column) -> Column:
    """Index of the largest value, the lowest index on ties."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def class_name(index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in CLASS_NAMES]), index + 1)


def probability_map(probabilities: Column) -> Column:
    """Class name -> probability rounded to six places."""
    return F.map_from_arrays(
        F.array(*[F.lit(name) for name in CLASS_NAMES]),
        F.transform(probabilities, lambda p: F.round(p.cast("double"), 6)),
    )


def standardise(value: Column, mean: Column, std: Column) -> Column:
    """(value - mean) / std, where a zero std divides by one."""
    return (value - mean) / F.when(std == 0, F.lit(1.0)).otherwise(std)
