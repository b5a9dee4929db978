"""Classification metrics derived from one 3x3 count per group.

The confusion counts are nine conditional counts of one hash aggregate: they combine map-side, so a
run with a third of all rows is no different from any other, and zeros need no join to a grid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearspan.functions.scores import class_name
from wearspan.schemas import CLASS_NAMES, CRITICAL

DOMAIN = range(len(CLASS_NAMES))


def _cell(truth: int, predicted: int) -> Column:
    return F.col(f"t{truth}_p{predicted}")


def _sum(columns: list[Column]) -> Column:
    return sum(columns[1:], columns[0])


def support(k: int) -> Column:
    return _sum([_cell(k, p) for p in DOMAIN])


def predicted_count(k: int) -> Column:
    return _sum([_cell(t, k) for t in DOMAIN])


def row_count() -> Column:
    return _sum([support(k) for k in DOMAIN])


def ratio(top: Column, bottom: Column) -> Column:
    """Zero when the denominator is zero."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def confusion(
    rows: DataFrame, truth: str, predicted: str, by: list[str] | None = None, times: str | None = None
) -> DataFrame:
    """One row per group with columns `t<truth>_p<predicted>`; `times` names how often a row counts."""

    def counted(cell: Column) -> Column:
        return F.count_if(cell) if times is None else F.coalesce(F.sum(F.when(cell, F.col(times))), F.lit(0).cast("long"))

    return rows.groupBy(*(by or [])).agg(
        *[
            counted((F.col(truth) == t) & (F.col(predicted) == p)).alias(f"t{t}_p{p}")
            for t in DOMAIN
            for p in DOMAIN
        ]
    )


def confusion_cells(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Long form: (truth, predicted, rows), zeros included."""
    cells = F.array(
        *[
            F.struct(F.lit(t).alias("truth"), F.lit(p).alias("predicted"), _cell(t, p).alias("rows"))
            for t in DOMAIN
            for p in DOMAIN
        ]
    )
    return counts.select(*(by or []), F.inline(cells))


def accuracy() -> Column:
    return ratio(_sum([_cell(k, k) for k in DOMAIN]), row_count())


def precision(k: int) -> Column:
    return ratio(_cell(k, k), predicted_count(k))


def recall(k: int) -> Column:
    return ratio(_cell(k, k), support(k))


def f_beta(k: int, beta: float) -> Column:
    b2 = beta * beta
    hits = (1 + b2) * _cell(k, k)
    missed = support(k) - _cell(k, k)
    false = predicted_count(k) - _cell(k, k)
    return ratio(hits, hits + b2 * missed + false)


def weighted(per_class: list[Column]) -> Column:
    return ratio(_sum([per_class[k] * support(k) for k in DOMAIN]), row_count())


def gate_metrics(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """accuracy, support-weighted F2 and recall of the critical class."""
    return counts.select(
        *(by or []),
        accuracy().alias("accuracy"),
        weighted([f_beta(k, 2.0) for k in DOMAIN]).alias("f2_weighted"),
        recall(CRITICAL).alias("critical_recall"),
    )


def class_report(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per-class precision, recall, F1 and support."""
    entries = F.array(
        *[
            F.struct(
                F.lit(k).alias("class"),
                precision(k).alias("precision"),
                recall(k).alias("recall"),
                f_beta(k, 1.0).alias("f1"),
                support(k).alias("support"),
            )
            for k in DOMAIN
        ]
    )
    return counts.select(*(by or []), F.inline(entries)).withColumn(
        "name", class_name(F.col("class"))
    )


def average_f1(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Macro F1 over the fixed three classes, and support-weighted F1."""
    scores = [f_beta(k, 1.0) for k in DOMAIN]
    return counts.select(
        *(by or []),
        (_sum(scores) / len(scores)).alias("f1_macro"),
        weighted(scores).alias("f1_weighted"),
    )


def baseline(counts: DataFrame, majority: int | Column, by: list[str] | None = None) -> DataFrame:
    """Accuracy and macro F1 of always answering `majority`, from the same counts."""
    majority = majority if isinstance(majority, Column) else F.lit(majority)
    hits = _sum([F.when(majority == k, support(k)).otherwise(F.lit(0)) for k in DOMAIN])
    share = ratio(hits, row_count())
    return counts.select(
        *(by or []),
        share.alias("baseline_accuracy"),
        (ratio(2 * share, share + 1) / len(CLASS_NAMES)).alias("baseline_f1_macro"),
        class_name(majority).alias("baseline_class"),
    )


def diagnostics(counts: DataFrame, majority: int | Column, by: list[str] | None = None) -> DataFrame:
    """Everything a run report holds, one row per group."""
    majority = majority if isinstance(majority, Column) else F.lit(majority)
    scores = [f_beta(k, 1.0) for k in DOMAIN]
    per_class = [
        column
        for k, name in enumerate(CLASS_NAMES)
        for column in (
            precision(k).alias(f"{name.lower()}_precision"),
            recall(k).alias(f"{name.lower()}_recall"),
            f_beta(k, 1.0).alias(f"{name.lower()}_f1"),
            support(k).alias(f"{name.lower()}_support"),
        )
    ]
    hits = _sum([F.when(majority == k, support(k)).otherwise(F.lit(0)) for k in DOMAIN])
    share = ratio(hits, row_count())
    return counts.select(
        *(by or []),
        accuracy().alias("accuracy"),
        (_sum(scores) / len(scores)).alias("f1_macro"),
        weighted(scores).alias("f1_weighted"),
        *per_class,
        share.alias("baseline_accuracy"),
        (ratio(2 * share, share + 1) / len(CLASS_NAMES)).alias("baseline_f1_macro"),
        class_name(majority).alias("baseline_class"),
        F.array(*[F.array(*[_cell(t, p) for p in DOMAIN]) for t in DOMAIN]).alias("confusion"),
    )


def mean_loss(losses: DataFrame, by: list[str], loss: str = "loss") -> DataFrame:
    """Mean batch loss per run and step."""
    return losses.groupBy(*by).agg(F.avg(loss).alias("train_loss"))


def weighted_log_loss(scored: DataFrame, truth: str, probabilities: str, weight: str) -> DataFrame:
    """Class-weighted cross entropy of scored rows."""
    assigned = F.greatest(F.get(F.col(probabilities), F.col(truth)).cast("double"), F.lit(1e-15))
    return scored.agg(
        (F.sum(-F.log(assigned) * F.col(weight)) / F.sum(weight)).alias("log_loss")
    )
