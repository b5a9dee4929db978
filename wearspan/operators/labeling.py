"""Remaining useful life, health class and cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearspan.operators.blocks import (
    LAST_KEY,
    BlockPlan,
    SplitPolicy,
    drop_block_columns,
    route,
)
from wearspan.operators.ranked import LongSeries, find_long_series, same_entity
from wearspan.schemas import (
    ALERT,
    ALERT_AT_RUL,
    CRITICAL,
    CRITICAL_AT_RUL,
    CYCLE,
    ENTITY,
    HEALTHY,
    IDENTIFIER_COLUMNS,
    LABEL,
)
from wearspan.session import spread

FLAT_STD = 1e-6


def entity_key(dataset: Column, unit: Column) -> Column:
    return F.concat_ws("_", dataset, unit.cast("string"))


def health_class(remaining: Column) -> Column:
    """Bucket remaining life; both bounds belong to the more urgent class."""
    return (
        F.when(remaining <= CRITICAL_AT_RUL, CRITICAL)
        .when(remaining <= ALERT_AT_RUL, ALERT)
        .otherwise(HEALTHY)
        .cast("int")
    )


def last_cycles(df: DataFrame) -> DataFrame:
    """Last cycle per engine, aggregated map-side first."""
    return df.groupBy(ENTITY).agg(F.max(CYCLE).alias("max_cycle"))


# Shares into which the rows of one long engine are dealt while the others look for their last cycle.
SALTS = 4_096


def label_telemetry(
    df: DataFrame,
    policy: SplitPolicy | None = None,
    plan: BlockPlan | None = None,
    long: LongSeries | None = None,
) -> DataFrame:
    """Add `RUL` and `failure_type`.

    The last cycle of an ordinary engine is a window over its rows. A long engine's is known from the size check (`long`, made
    here if it is not given) or the block plan, and its rows are spread evenly, whatever their cycles are.
    """
    if plan is not None:
        routed, keys, last, total = route(df, plan), plan.partition_keys, F.col(LAST_KEY), plan.rows
    else:
        long = long or find_long_series(df, ENTITY, CYCLE, policy)
        total = long.total
        if long.table is None:
            routed, keys, last = df, [ENTITY], None
        else:
            known = df.join(long.hinted.select("_e", F.col("_last").alias(LAST_KEY), F.lit(True).alias("_long")), same_entity(ENTITY), "left").drop("_e")
            share = F.when(F.col("_long"), F.monotonically_increasing_id() % SALTS).otherwise(0)
            routed, keys, last = known.withColumn("_salt", share).drop("_long"), [ENTITY, "_salt"], F.col(LAST_KEY)
    # What follows keyed by the engine, dropping of duplicates included, finds its rows dealt out here.
    routed = spread(routed, total, *keys)
    found = F.max(CYCLE).over(Window.partitionBy(*keys))
    last = found if last is None else F.coalesce(last, found)
    labeled = routed.withColumn("RUL", (last - F.col(CYCLE)).cast("long")).withColumn(
        LABEL, health_class(F.col("RUL"))
    )
    return drop_block_columns(labeled).drop("_salt")


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Exact duplicates only. Copies collapse map-side, before the shuffle."""
    return df.dropDuplicates()


def sensor_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "sensor" in c]


def sensor_spread(df: DataFrame) -> DataFrame:
    """One row: sample standard deviation of every sensor, in one pass."""
    return df.agg(*[F.stddev_samp(c).alias(c) for c in sensor_columns(df)])


def flat_sensors(df: DataFrame) -> list[str]:
    """Sensors whose spread is below the limit; an undefined spread counts as varying."""
    candidates = sensor_columns(df)
    if not candidates:
        return []
    spread = sensor_spread(df).first()
    return [c for c in candidates if spread[c] is not None and spread[c] < FLAT_STD]


def clean_telemetry(df: DataFrame) -> DataFrame:
    """Drop duplicates, flat sensors and the helper columns.

    The flat test needs the deduplicated rows once and the result needs them again; callers that
    run at scale pass a written table through `drop_flat` instead of repeating the dedup shuffle.
    """
    return drop_flat(drop_duplicate_rows(df))


def drop_flat(deduplicated: DataFrame) -> DataFrame:
    return deduplicated.drop(*flat_sensors(deduplicated), "RUL", "dataset_id")


def feature_columns(df: DataFrame) -> list[str]:
    """Model inputs, in table order."""
    return [c for c in df.columns if c not in IDENTIFIER_COLUMNS]
