"""Training run: split, scale, fit candidates, test, gate, promote."""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.functions.times import epoch_micros
from wearspan.operators.lineage import digests_of_packed, fingerprint, lineage_tags
from wearspan.operators.metrics import diagnostics, gate_metrics
from wearspan.operators.packed import merged_moments, pack_windows, step_moments
from wearspan.operators.registry import judge_challengers
from wearspan.operators.sampling import SPLITS, SplitRule, split_rule, split_sizes
from wearspan.operators.scaling import ScalerState
from wearspan.operators.selection import best_checkpoints, completed_steps, enforce_gate
from wearspan.operators.training import candidate_history, evaluate
from wearspan.operators.weights import class_weights, majority_class
from wearspan.params import JobParams
from wearspan.schemas import CLASS_NAMES, LABEL
from wearspan.session import ship, written
from wearspan.sources.ledger import Ledger
from wearspan.sources.tables import (
    check_training_table,
    feature_names,
    read_manifest,
    read_windows,
)

HISTORY_METRICS = ["train_loss", "accuracy", "f2_weighted", "critical_recall"]


def window_scaler(train: DataFrame, names: list[str]) -> DataFrame:
    """Scaler state from windows, packed or not: (position, feature, mean, std, n).

    A step counts once for every window that holds it. Each task sends back one row, which has two numbers a feature; a missing
    value counts as 0, and the std is the population one.
    """
    width = len(names)
    packed = train if "starts" in train.columns else pack_windows(train, width)
    ship(train.sparkSession)

    def task(batches):
        sums = step_moments(batches, width)
        if sums is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in sums], names=["n", "mean", "spread"])

    rows = packed.select("labels", "starts", "size", "values").mapInArrow(task, "n double, mean array<double>, spread array<double>")
    found = [(r["n"], np.array(r["mean"]), np.array(r["spread"])) for r in rows.collect()]  # one row per task
    if not found:
        raise ValueError("there is no training window")
    count, mean, spread = reduce(merged_moments, found)
    state = [(i, name, float(mean[i]), float((spread[i] / count) ** 0.5), int(count)) for i, name in enumerate(names)]
    return train.sparkSession.createDataFrame(
        state, "position int, feature string, mean double, std double, n long"
    )


def positioned(windows: DataFrame) -> DataFrame:
    """Position of each window in the table, from its event time.

    The build spaces event times ten seconds apart in canonical order, so the distance from the
    first one is the position: a scalar subquery, no sort and no join of the wide rows.
    """
    micros = epoch_micros("event_timestamp")
    first = windows.agg(F.min(micros)).scalar()
    return windows.withColumn("window_index", F.floor((micros - first) / 10_000_000))


def packed_parts(rows: DataFrame, rule: SplitRule, width: int) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The window table packed and written once, in a folder per split, and the records of each split."""
    placed = positioned(rows)
    if rule.cutoffs is None:
        packed = written(pack_windows(placed, width, "window_index"), "packed")
        return packed, dict.fromkeys(SPLITS, packed)
    split = placed.withColumn("split", rule.column(F.col("engine_id")))
    packed = written(pack_windows(split, width, "window_index", by="split"), "packed", "part")
    return packed, {s: packed.filter(F.col("part") == s) for s in SPLITS}


def train_and_evaluate(
    spark: SparkSession,
    data_dir: str,
    ledger: Ledger,
    params: JobParams,
    lineage: dict | None = None,
    run_id: str | None = None,
) -> dict:
    """One run. Returns its row; raises `GateFailed` after the ledger write when enforced."""
    run_id = run_id or uuid.uuid4().hex
    names = feature_names(read_manifest(spark, data_dir))
    rows = check_training_table(read_windows(spark, data_dir), names, params.window_size)
    rule = split_rule(rows, params.val_split, params.test_split, params.seed, key="engine_id")
    packed, parts = packed_parts(rows, rule, len(names))
    digests = digests_of_packed(packed, len(names))
    content = fingerprint(
        digests, names, params.val_split, params.test_split, params.seed
    ).first()["fingerprint"]

    assigned = rule.assigned(rows.select("engine_id"), "engine_id")
    sizes = {r["split"]: r for r in split_sizes(assigned).collect()}  # three rows
    scaler = window_scaler(parts["train"], names)
    state = ScalerState.of(scaler)
    labels = parts["train"].select(F.explode("labels").alias(LABEL))
    weights = {r["class"]: r["weight"] for r in class_weights(labels).collect()}
    majority = majority_class(labels).first()["majority_class"]

    ledger.log_tags(
        run_id, {**(lineage or lineage_tags(data_dir=data_dir)), "fingerprint": content}
    )
    ledger.log_params(
        run_id,
        {
            "window_size": params.window_size,
            "num_features": len(names),
            "candidates": len(params.reg_params),
            "reg_params": ",".join(map(str, params.reg_params)),
            "max_iter": params.max_iter,
            "patience": params.patience,
            "val_split": params.val_split,
            "test_split": params.test_split,
            "seed": params.seed,
            **{f"{s}_samples": sizes[s]["rows"] for s in sizes},
            **{f"{s}_engines": sizes[s]["engines"] for s in sizes},
        },
    )

    # Steps are scaled for every pass, records at a time; no copy of the windows is kept.
    models, history = candidate_history(
        parts["train"],
        parts["val"],
        state,
        weights,
        params.reg_params,
        params.max_iter,
        run_id,
    )
    ran = completed_steps(history, params.patience)
    ledger.append_history(ran, HISTORY_METRICS)
    best = best_checkpoints(ran, params.f2_threshold, params.critical_recall_threshold).first()
    model = models[best["step"]]

    counts = written(evaluate(parts["test"], model, state), "test-counts")  # one row
    test = gate_metrics(counts).first()
    report = diagnostics(counts, majority).withColumn("run_id", F.lit(run_id))
    ledger.append_report(report)
    summary = report.first()
    ledger.log_metrics(
        run_id,
        {
            "best_val_accuracy": best["accuracy"],
            "best_val_f2_weighted": best["f2_weighted"],
            "best_val_critical_recall": best["critical_recall"],
            "test_accuracy": test["accuracy"],
            "test_f2_weighted": test["f2_weighted"],
            "test_critical_recall": test["critical_recall"],
            "test_f1_macro": summary["f1_macro"],
            "test_f1_weighted": summary["f1_weighted"],
            **{
                f"test_{name.lower()}_{metric}": summary[f"{name.lower()}_{metric}"]
                for name in CLASS_NAMES
                for metric in ("precision", "recall", "f1")
            },
            "baseline_test_accuracy": summary["baseline_accuracy"],
            "baseline_test_f1_macro": summary["baseline_f1_macro"],
        },
    )
    ledger.save_model(run_id, model, scaler, params.window_size, len(names))

    passes = (
        test["f2_weighted"] >= params.f2_threshold
        and test["critical_recall"] >= params.critical_recall_threshold
    )
    challenger = spark.createDataFrame(
        [(params.model_name, run_id, content, test["f2_weighted"], passes)],
        "model_name string, run_id string, fingerprint string, f2_weighted double, passes boolean",
    )
    decision = judge_challengers(challenger, ledger.promotions(), ledger.runs()).first()
    version = None
    if decision["outcome"] == "promoted":
        version = ledger.promote(params.model_name, run_id)
    ledger.log_tags(
        run_id,
        {
            "quality_gate_passed": passes,
            "quality_gate_f2_threshold": params.f2_threshold,
            "quality_gate_critical_recall_threshold": params.critical_recall_threshold,
            "outcome": decision["outcome"],
            "promoted_version": version if version is not None else "none",
        },
    )
    run = {
        "run_id": run_id,
        "fingerprint": content,
        "best_step": best["step"],
        "f2_weighted": test["f2_weighted"],
        "critical_recall": test["critical_recall"],
        "accuracy": test["accuracy"],
        "f1_macro": summary["f1_macro"],
        "baseline_f1_macro": summary["baseline_f1_macro"],
        "passes": passes,
        "reason": decision["reason"],
        "outcome": decision["outcome"],
        "version": version,
    }
    if params.enforce_gate:
        enforce_gate(run, params.f2_threshold, params.critical_recall_threshold)
    return run


