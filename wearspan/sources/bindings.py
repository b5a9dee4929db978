"""Views of the given star-schema tables as telemetry, requests and metric tables.

A supplier plays the engine: its line items, in shipping order, are the cycles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.functions.times import epoch_micros
from wearspan.operators.blocks import BlockPlan, SplitPolicy, order_key
from wearspan.operators.labeling import label_telemetry
from wearspan.operators.ordinals import series_ordinal
from wearspan.operators.ranked import find_long_series
from wearspan.schemas import CYCLE, ENTITY

# Every column takes part, because (orderkey, linenumber) repeats.
LINE_ORDER = [
    "l_shipdate",
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]
FLAT_READING = 518.67
FIXED_SETTING = 100.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_plan(spark: SparkSession, sf_dir: str, policy: SplitPolicy | None = None) -> BlockPlan | None:
    """A plan with nothing to cut, or None when some supplier is long and series are to be cut by rank.

    Its key is the engine, which is the supplier by another name: lines that are dealt out by it to be numbered lie as the
    steps after them need them.
    """
    lines = table(spark, sf_dir, "lineitem")
    long = find_long_series(lines, "l_suppkey", LINE_ORDER[0], policy)
    return BlockPlan(ENTITY, order_key(lines, LINE_ORDER[0]), rows=long.total) if long.table is None else None


def engine_columns() -> dict[str, Column]:
    """Sub-dataset, unit and engine of a supplier."""
    dataset = F.concat(F.lit("FD00"), (F.col("l_suppkey") % 4 + 1).cast("string"))
    unit = F.col("l_suppkey") + 1
    return {"dataset_id": dataset, "unit_number": unit, ENTITY: F.concat_ws("_", dataset, unit.cast("string"))}


def numbered_lines(spark: SparkSession, sf_dir: str, plan: BlockPlan | None = None) -> DataFrame:
    """`lineitem` plus the 1-based cycle of each line in its supplier's series; with a `plan` also its engine."""
    lines = table(spark, sf_dir, "lineitem")
    if plan is not None:
        lines = lines.withColumn(ENTITY, engine_columns()[ENTITY])
    return series_ordinal(lines, "l_suppkey", LINE_ORDER, CYCLE, plan=plan)


def telemetry(
    spark: SparkSession,
    sf_dir: str,
    keep: tuple[str, ...] = (),
    plan: BlockPlan | None = None,
) -> DataFrame:
    """Raw telemetry: keys, three settings, four varying sensors and a flat one."""
    derived = engine_columns()
    return numbered_lines(spark, sf_dir, plan).select(
        derived["unit_number"].alias("unit_number"),
        CYCLE,
        F.col("l_linenumber").cast("double").alias("op_setting_1"),
        ((F.col("l_partkey") % 100) / 100.0).alias("op_setting_2"),
        F.lit(FIXED_SETTING).alias("op_setting_3"),
        F.col("l_quantity").alias("sensor_1"),
        F.col("l_extendedprice").alias("sensor_2"),
        F.col("l_discount").alias("sensor_3"),
        F.col("l_tax").alias("sensor_4"),
        F.lit(FLAT_READING).alias("sensor_5"),
        derived["dataset_id"].alias("dataset_id"),
        derived[ENTITY].alias(ENTITY) if plan is None else ENTITY,
        *keep,
    )


def labeled_series(
    spark: SparkSession,
    sf_dir: str,
    keep: tuple[str, ...] = (),
    policy: SplitPolicy | None = None,
) -> tuple[DataFrame, BlockPlan | None]:
    """Labeled telemetry and the block plan of its engines, None when they are to be cut by rank.

    A supplier is an engine, so the size check of the line items also answers for the engines: only
    when some supplier is long are the engines' own cycles cut. The numbering has dealt the lines out by engine, so the plan
    of the engines counts no rows and asks for no second exchange.
    """
    lines = line_plan(spark, sf_dir, policy)
    rows = telemetry(spark, sf_dir, keep, lines)
    if lines is None:
        return label_telemetry(rows, policy), None
    plan = BlockPlan(ENTITY, order_key(rows, CYCLE))
    return label_telemetry(rows, plan=plan), plan


def labeled(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return labeled_series(spark, sf_dir, keep)[0]


def with_copies(rows: DataFrame) -> DataFrame:
    """Repeat the rows of every fiftieth order exactly, and drop the order key."""
    copies = F.when(F.col("l_orderkey") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return rows.withColumn("_copy", F.explode(copies)).drop("_copy", "l_orderkey")


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as a live feed: user = engine, microseconds = cycle, two sensors."""
    return event_telemetry(table(spark, sf_dir, "events"))


def event_telemetry(events: DataFrame) -> DataFrame:
    return events.select(
        F.concat(F.lit("U_"), F.col("user_id").cast("string")).alias(ENTITY),
        epoch_micros("ts").alias(CYCLE),
        F.col("value").alias("sensor_1"),
        F.get_json_object("props", "$.k").cast("double").alias("sensor_2"),
    )
