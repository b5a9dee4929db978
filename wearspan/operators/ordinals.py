"""Row positions without a global or per-series single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearspan.operators.blocks import (
    OFFSET,
    BlockPlan,
    SplitPolicy,
    drop_block_columns,
    route,
)
from wearspan.operators.ranked import RANK, SIZE, split_by_rank
from wearspan.session import scratch_path, spread

# Hex digits of a digest used as a bucket: 4,096 buckets per stratum.
BUCKET_HEX = 3


def series_ordinal(
    df: DataFrame,
    entity: str,
    order_by: list[str],
    name: str,
    policy: SplitPolicy | None = None,
    plan: BlockPlan | None = None,
) -> DataFrame:
    """1-based position of each row in its series: rank inside a block plus the block's offset.

    Long series are cut by rank; with a `plan` along its keys.
    """
    if plan is None:
        split = split_by_rank(df, entity, order_by, policy=policy)
        routed, keys, order = split.dealt, split.keys, split.order
    else:
        keys, order = plan.partition_keys, order_by
        routed = spread(route(df, plan), plan.rows, *keys)
    inside = Window.partitionBy(*keys).orderBy(*order)
    numbered = routed.withColumn(
        name, (F.row_number().over(inside) + F.col(OFFSET)).cast("long")
    )
    return drop_block_columns(numbered).drop(RANK, SIZE)


def series_bounds(
    df: DataFrame, entity: str, order_by: list[str], policy: SplitPolicy | None = None
) -> DataFrame:
    """First and last 1-based position of each series in the global (entity, order) ordering."""
    sizes = df.groupBy(entity).agg(F.count(F.lit(1)).alias("rows"))
    starts = running_offsets(sizes, entity, "rows")
    return starts.select(
        entity,
        (F.col("offset") + 1).alias("start_position"),
        (F.col("offset") + F.col("rows")).alias("end_position"),
    )


def running_offsets(sizes: DataFrame, entity: str, count: str) -> DataFrame:
    """Sum of `count` over all entities that sort before, as `offset`.

    Range-partition the entity table, total each partition, and shift every partition by the sum of
    the earlier ones: only one row per partition is ever ordered globally. The partitioned table is
    written once, because both passes must see the same partition bounds even when a task is rerun.
    """
    spark = sizes.sparkSession
    path = scratch_path(spark, "offsets")
    (
        sizes.repartitionByRange(entity)
        .withColumn("_part", F.spark_partition_id())
        .write.parquet(path)
    )
    ranged = spark.read.parquet(path)
    totals = ranged.groupBy("_part").agg(F.sum(count).alias("_total"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(
        "_part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_shift")
    )
    inside = (
        Window.partitionBy("_part").orderBy(entity).rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per range partition: at most spark.sql.shuffle.partitions rows are broadcast.
    return (
        ranged.join(F.broadcast(shifts), "_part")
        .withColumn(
            "offset",
            (F.col("_shift") + F.coalesce(F.sum(count).over(inside), F.lit(0))).cast("long"),
        )
        .drop("_part", "_shift")
    )


def digest_rank(df: DataFrame, digest: Column, tie: str, strata: list[str], name: str) -> DataFrame:
    """1-based rank by a uniform digest, over all rows or inside each stratum.

    Rows are ranked inside digest-prefix buckets and shifted by the sizes of the earlier buckets. A
    digest spreads any input evenly, so one huge stratum is still ranked by thousands of tasks.
    """
    hashed = df.withColumn("_digest", digest).withColumn(
        "_bucket", F.substring("_digest", 1, BUCKET_HEX)
    )
    # A constant stratum keeps the unstratified case on the same path.
    keys = strata or ["_all"]
    if not strata:
        hashed = hashed.withColumn("_all", F.lit(0))
    sizes = hashed.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        *keys, "_bucket", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_shift")
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_digest", tie)
    return (
        hashed.join(shifts, [*keys, "_bucket"])
        .withColumn(name, (F.row_number().over(inside) + F.col("_shift")).cast("long"))
        .drop("_digest", "_bucket", "_shift", "_all")
    )
