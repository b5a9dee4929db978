"""Champion lookup and champion/challenger decisions over plain tables.

`promotions` is append-only: the champion of a model is its latest promotion.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearspan.operators.selection import outcome


def champions(promotions: DataFrame) -> DataFrame:
    """Latest promotion per model. Aggregates map-side; no per-model sort."""
    latest = F.max_by(F.struct("version", "run_id", "promoted_at"), F.struct("promoted_at", "version"))
    return (
        promotions.groupBy("model_name")
        .agg(latest.alias("_p"))
        .select("model_name", "_p.version", "_p.run_id", "_p.promoted_at")
    )


def champion_runs(promotions: DataFrame, runs: DataFrame) -> DataFrame:
    """Champion joined to its run: `fingerprint` and `f2_weighted` are NULL when a hop is absent."""
    facts = runs.select("run_id", "fingerprint", "f2_weighted")
    return champions(promotions).join(facts, "run_id", "left")


def judge_challengers(
    challengers: DataFrame, promotions: DataFrame, runs: DataFrame
) -> DataFrame:
    """Add `replaces`, `reason` and `outcome` to challenger runs.

    A challenger needs `model_name`, `run_id`, `fingerprint`, `f2_weighted` and `passes`. It is
    compared on F2 only with a champion measured on the same data; an equal F2 replaces.
    """
    champion = champion_runs(promotions, runs).select(
        "model_name",
        F.col("version").alias("champion_version"),
        F.col("run_id").alias("champion_run"),
        F.col("fingerprint").alias("champion_fingerprint"),
        F.col("f2_weighted").alias("champion_f2"),
    )
    reason = (
        F.when(F.col("champion_version").isNull(), "no_champion")
        .when(F.col("champion_run").isNull(), "champion_without_run")
        .when(~F.col("champion_fingerprint").eqNullSafe(F.col("fingerprint")), "other_data")
        .when(F.col("champion_f2").isNull(), "champion_without_f2")
        .when(F.col("f2_weighted") >= F.col("champion_f2"), "not_worse")
        .otherwise("worse")
    )
    return (
        challengers.join(champion, "model_name", "left")
        .withColumn("reason", reason)
        .withColumn("replaces", F.col("reason") != "worse")
        .withColumn("outcome", outcome(F.col("passes"), F.col("replaces")))
    )


def consistent_shapes(shapes: DataFrame, default_window: int) -> DataFrame:
    """Window and feature counts from a run's artifacts.

    The scaler decides the feature count. The model's own shape gives the window, the default fills
    in when it is unknown or not positive, and a model that disagrees with its scaler is marked.
    """
    known = (F.col("window_size") > 0) & (F.col("model_features") > 0)
    usable = F.coalesce(known, F.lit(False))
    return shapes.select(
        "run_id",
        F.when(usable, F.col("window_size")).otherwise(F.lit(default_window)).alias("window_size"),
        F.col("scaler_features").alias("num_features"),
        (~usable | (F.col("model_features") == F.col("scaler_features"))).alias("consistent"),
    )


def describe_champions(
    promotions: DataFrame, shapes: DataFrame, manifests: DataFrame, default_window: int
) -> DataFrame:
    """Model description: status, version, shape and ordered feature names of each champion.

    A champion without a shape row has the default window and as many features as its manifest has names; one whose
    model disagrees with its scaler is left out, as it cannot be loaded.
    """
    names = (
        manifests.groupBy("run_id")
        .agg(F.array_sort(F.collect_list(F.struct("position", "feature"))).alias("_f"))
        .select("run_id", F.col("_f.feature").alias("feature_names"))
    )
    return (
        champions(promotions)
        .filter("run_id IS NOT NULL")
        .join(consistent_shapes(shapes, default_window), "run_id", "left")
        .filter(F.coalesce("consistent", F.lit(True)))
        .join(names, "run_id", "left")
        .select(
            F.lit("ok").alias("status"),
            "model_name",
            F.col("version").cast("string").alias("model_version"),
            F.coalesce("window_size", F.lit(default_window)).alias("window_size"),
            F.coalesce("num_features", F.size("feature_names")).alias("num_features"),
            "feature_names",
        )
    )
