"""Quality gate, checkpoint choice and early stopping over a metric history.

A history has one row per (run, step). It is as long as the number of steps a run was allowed, so a
window per run is small however many rows each step was measured on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def passes_gate(
    f2: Column, critical_recall: Column, f2_threshold: float, recall_threshold: float
) -> Column:
    """Both thresholds must be reached; reaching one exactly counts."""
    return F.coalesce(
        (f2 >= F.lit(f2_threshold)) & (critical_recall >= F.lit(recall_threshold)), F.lit(False)
    )


def gate_runs(runs: DataFrame, f2_threshold: float, recall_threshold: float) -> DataFrame:
    return runs.withColumn(
        "passes",
        passes_gate(F.col("f2_weighted"), F.col("critical_recall"), f2_threshold, recall_threshold),
    )


def patience_counter(history: DataFrame) -> DataFrame:
    """Add `best_f2` so far, `improved` (strictly above every earlier step) and `since_improved`."""
    earlier = Window.partitionBy("run_id").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy("run_id").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    before = F.max("f2_weighted").over(earlier)
    marked = history.withColumn(
        "improved", F.col("f2_weighted") > F.coalesce(before, F.lit(-1.0))
    ).withColumn("_position", F.row_number().over(Window.partitionBy("run_id").orderBy("step")))
    last = F.max(F.when(F.col("improved"), F.col("_position"))).over(so_far)
    return (
        marked.withColumn("best_f2", F.max("f2_weighted").over(so_far))
        .withColumn("since_improved", (F.col("_position") - F.coalesce(last, F.lit(0))).cast("int"))
        .drop("_position")
    )


def stop_steps(history: DataFrame, patience: int) -> DataFrame:
    """(run_id, stop_step): first step with `patience` steps and no improvement; NULL if none."""
    counted = patience_counter(history)
    return counted.groupBy("run_id").agg(
        F.min(F.when(F.col("since_improved") >= patience, F.col("step"))).alias("stop_step")
    )


def completed_steps(history: DataFrame, patience: int) -> DataFrame:
    """The steps that ran: none after the early stop."""
    stopped = F.min(F.when(F.col("since_improved") >= patience, F.col("step"))).over(
        Window.partitionBy("run_id")
    )
    return (
        patience_counter(history)
        .withColumn("stop_step", stopped)
        .filter(F.col("stop_step").isNull() | (F.col("step") <= F.col("stop_step")))
    )


def best_checkpoints(
    history: DataFrame, f2_threshold: float, recall_threshold: float
) -> DataFrame:
    """The step to restore per run: a passing step first, then the highest F2, then the earliest."""
    gated = gate_runs(history, f2_threshold, recall_threshold)
    # The maximum of an ordered struct combines map-side; the step is negated to prefer the first.
    key = F.struct("passes", "f2_weighted", (-F.col("step")).alias("_earliest"))
    kept = [c for c in gated.columns if c not in ("run_id", "passes", "f2_weighted", "step")]
    best = gated.groupBy("run_id").agg(F.max_by(F.struct(*gated.columns), key).alias("_best"))
    return best.select(
        "run_id", *[F.col(f"_best.{c}").alias(c) for c in ("step", "passes", "f2_weighted", *kept)]
    )


def outcome(passes: Column, replaces: Column) -> Column:
    return (
        F.when(~passes, "gate_failed").when(replaces, "promoted").otherwise("champion_is_better")
    )


class GateFailed(RuntimeError):
    """Raised for a run below the quality gate when the gate is enforced."""


def enforce_gate(run: dict, f2_threshold: float, recall_threshold: float) -> None:
    if run["f2_weighted"] >= f2_threshold and run["critical_recall"] >= recall_threshold:
        return
    raise GateFailed(
        f"run {run['run_id']}: f2_weighted {run['f2_weighted']:.4f} (needs {f2_threshold}), "
        f"critical_recall {run['critical_recall']:.4f} (needs {recall_threshold})"
    )
