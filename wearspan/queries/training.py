"""Training and scoring with a fitted model over the whole feature build."""

from __future__ import annotations

from pyspark.sql import functions as F

from wearspan.params import JobParams
from wearspan.plans.score import score_table
from wearspan.plans.train import HISTORY_METRICS, train_and_evaluate
from wearspan.queries.catalog import query
from wearspan.queries.datasets import built
from wearspan.session import scratch_path
from wearspan.sources.ledger import Ledger
from wearspan.sources.tables import read_windows

PARAMS = JobParams(
    f2_threshold=0.0,
    critical_recall_threshold=0.0,
    reg_params=(0.001, 0.01),
    max_iter=10,
)


def trained(spark, sf_dir) -> tuple[str, Ledger, dict]:
    folder = built(spark, sf_dir)
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    return folder, ledger, train_and_evaluate(spark, folder, ledger, PARAMS)


@query("trn_1_training_run")
def training_run(spark, sf_dir):
    """Fit, choose, test and promote: the run's final metrics."""
    _, ledger, run = trained(spark, sf_dir)
    return (
        ledger.metrics()
        .filter((F.col("run_id") == run["run_id"]) & F.col("step").isNull())
        .select("metric", F.round("value", 6).alias("value"))
        .distinct()
    )


@query("trn_2_candidate_history")
def candidates(spark, sf_dir):
    """One step per candidate: training loss and validation metrics."""
    _, ledger, run = trained(spark, sf_dir)
    steps = ledger.metrics().filter(
        (F.col("run_id") == run["run_id"]) & F.col("metric").isin(*HISTORY_METRICS)
    )
    return steps.filter("step IS NOT NULL").select("step", "metric", F.round("value", 6).alias("value"))


@query("scr_1_champion_scoring")
def champion_scoring(spark, sf_dir):
    """Every window answered by the champion with its own scaler."""
    folder, ledger, _ = trained(spark, sf_dir)
    champion = ledger.champion(PARAMS.model_name, PARAMS.window_size)
    answers = score_table(read_windows(spark, folder), champion)
    return answers.groupBy("engine_id", "prediction", "model_version").agg(
        F.count(F.lit(1)).alias("windows"),
        F.round(F.avg(F.col("probabilities")["Critical"]), 4).alias("mean_critical"),
    )
