"""Class balance of the training rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearspan.functions.scores import class_name
from wearspan.schemas import CLASS_NAMES, LABEL


def class_counts(rows: DataFrame) -> DataFrame:
    """One row: `n_0`, `n_1`, `n_2`."""
    return rows.agg(
        *[F.count_if(F.col(LABEL) == k).alias(f"n_{k}") for k in range(len(CLASS_NAMES))]
    )


def class_weights(rows: DataFrame) -> DataFrame:
    """(class, name, rows, weight): `n / (present classes * rows)`, and 1.0 for an absent class."""
    domain = range(len(CLASS_NAMES))
    counts = [F.col(f"n_{k}") for k in domain]
    total = sum(counts[1:], counts[0])
    present = sum([(c > 0).cast("int") for c in counts[1:]], (counts[0] > 0).cast("int"))
    entries = F.array(
        *[
            F.struct(
                F.lit(k).alias("class"),
                counts[k].alias("rows"),
                F.when(counts[k] > 0, total / (present * counts[k])).otherwise(F.lit(1.0)).alias("weight"),
            )
            for k in domain
        ]
    )
    return (
        class_counts(rows)
        .select(F.inline(entries))
        .select("class", class_name(F.col("class")).alias("name"), "rows", "weight")
    )


def majority_class(rows: DataFrame) -> DataFrame:
    """One row: the most frequent class, the lowest index on ties."""
    counts = F.array(*[F.col(f"n_{k}") for k in range(len(CLASS_NAMES))])
    return class_counts(rows).select(
        (F.array_position(counts, F.array_max(counts)) - 1).cast("int").alias("majority_class")
    )


def weight_column(weights: dict[int, float]) -> Column:
    """Weight of a row by its label, for a trainer's weight column."""
    expr = F.lit(1.0)
    for k, weight in weights.items():
        expr = F.when(F.col(LABEL) == k, F.lit(float(weight))).otherwise(expr)
    return expr


def attach_weights(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """Join the three-row weight table to the rows; a label outside the classes weighs 1, as in `weight_column`."""
    small = F.broadcast(weights.select(F.col("class").alias(LABEL), "weight"))
    return rows.join(small, LABEL, "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))
