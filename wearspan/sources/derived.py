"""Run, registry, request and score tables derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.functions.arrays import reshape
from wearspan.functions.scores import argmax, softmax
from wearspan.operators.metrics import confusion, gate_metrics
from wearspan.schemas import ENTITY, LABEL
from wearspan.sources.bindings import labeled, table

STEPS = 11
SIDE = 8  # an embedding of 64 values is read as 8 time steps of 8 features


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labeled telemetry with a fixed rule's answer: truth and prediction pairs."""
    level = F.round(F.col("sensor_3") * 100).cast("int")
    return (
        labeled(spark, sf_dir)
        .withColumn("level", level)
        .withColumn(
            "predicted", F.when(F.col("level") >= 8, 2).when(F.col("level") >= 5, 1).otherwise(0)
        )
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric history: one run per engine, one step per rule threshold.

    Rows are counted by engine, level and label first; only those few counts are multiplied by the steps.
    """
    step = F.col("step")
    answered = (
        judged(spark, sf_dir)
        .groupBy(ENTITY, LABEL, "level")
        .agg(F.count(F.lit(1)).alias("times"))
        .withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(STEPS - 1))))
        .withColumn(
            "answer",
            F.when(F.col("level") >= step, 2).when(F.col("level") >= step - 3, 1).otherwise(0),
        )
        .withColumn("run_id", F.concat(F.lit("run_"), F.col(ENTITY)))
    )
    return gate_metrics(
        confusion(answered, LABEL, "answer", ["run_id", "step"], "times"), ["run_id", "step"]
    )


def engine_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One finished run per engine: data fingerprint and F2, missing for every seventh."""
    counts = confusion(judged(spark, sf_dir), LABEL, "predicted", [ENTITY, "unit_number"])
    healthy = F.col("t0_p0") + F.col("t0_p1") + F.col("t0_p2")
    keys = [ENTITY, "unit_number", "healthy"]
    measured = gate_metrics(counts.withColumn("healthy", healthy), keys)
    return measured.select(
        F.concat(F.lit("run_"), F.col(ENTITY)).alias("run_id"),
        F.concat(F.lit("fp_"), (F.col("healthy") % 3).cast("string")).alias("fingerprint"),
        F.when(F.col("unit_number") % 7 != 0, F.col("f2_weighted")).alias("f2_weighted"),
    )


def promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promotion log from orders: some promotions have no run, some name a run that is unknown."""
    slot = F.col("o_orderkey") % 120
    run = F.concat(
        F.lit("run_FD00"), (slot % 4 + 1).cast("string"), F.lit("_"), (slot + 1).cast("string")
    )
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("model_"), (F.col("o_custkey") % 40).cast("string")).alias("model_name"),
        F.col("o_orderkey").alias("version"),
        F.when(F.col("o_orderkey") % 13 != 0, run).alias("run_id"),
        F.col("o_orderdate").alias("promoted_at"),
    )


def challengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("model_"), (F.col("c_custkey") % 45).cast("string")).alias("model_name"),
        F.concat(F.lit("try_"), F.col("c_custkey").cast("string")).alias("run_id"),
        F.concat(F.lit("fp_"), (F.col("c_custkey") % 3).cast("string")).alias("fingerprint"),
        (F.abs("c_acctbal") / F.lit(10000.0)).alias("f2_weighted"),
        (F.col("c_nationkey").cast("double") / F.lit(25.0)).alias("critical_recall"),
    )


def shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifact shapes per run: some windows are unknown, some models disagree with the scaler."""
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("run_"), key.cast("string")).alias("run_id"),
        F.when(key % 9 == 0, F.lit(None)).when(key % 8 == 0, -1).otherwise(20).cast("int").alias("window_size"),
        F.when(key % 5 == 0, 8).otherwise(7).alias("model_features"),
        F.lit(7).alias("scaler_features"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests from embeddings, a share of them broken in each way a contract knows."""
    vec = F.col("vec_id")
    matrix = F.transform(
        reshape(F.col("embedding").cast("array<double>"), SIDE, SIDE),
        lambda row, i: F.when((vec % 7 == 0) & (i == 3), F.slice(row, 1, SIDE - 1))
        .when((vec % 11 == 0) & (i == 5), F.array_append(F.slice(row, 1, SIDE - 1), F.lit(float("nan"))))
        .otherwise(row),
    )
    empty = F.array().cast("array<array<double>>")
    name = F.concat_ws("_", F.lit("ENG"), F.col("label").cast("string"), vec.cast("string"))
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.when(vec % 17 == 0, "   ")
        .when(vec % 19 == 0, F.repeat(F.lit("e"), F.lit(65)))
        .otherwise(name)
        .alias("engine_id"),
        F.when(vec % 23 == 0, empty).otherwise(matrix).alias("readings"),
    )


def class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three class scores per embedding."""
    scores = F.transform(
        F.slice("embedding", 1, 3), lambda x: x.cast("double") * F.lit(10.0)
    )
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", scores.alias("scores"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class scores turned into probabilities and an answer, one row per embedding."""
    probabilities = softmax(F.col("scores"))
    return (
        class_scores(spark, sf_dir)
        .withColumn("engine_id", F.concat(F.lit("ENG_"), F.col("label").cast("string")))
        .withColumn("probabilities", probabilities)
        .withColumn("predicted", argmax(F.col("probabilities")))
    )
