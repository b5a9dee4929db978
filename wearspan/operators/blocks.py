"""Splitting very long series into blocks, so that no series has to fit one task.

`Window.partitionBy(entity)` sends a whole series to one task. Series sizes are therefore checked
first (one aggregate over the entity column). When no series is above `rows_per_block`, windows
partition by the entity alone. Otherwise a long series is cut along its order key and
`(entity, block)` becomes the partition key; every other series keeps block 0, so the rows are still
shuffled once.

The cutting limit is `max(rows_per_block, rows / max_split_entities)`. Fewer than
`max_split_entities` series can be above it, and they have at most
`2 * cells_per_block * max_split_entities` cells between them, whatever the input size: that is the
proof behind the two broadcasts in `route`.

Cells are equal slices of a long series' key range. Neighbouring cells are merged into blocks by
their running row count, so uneven keys still give even blocks; one key value is the smallest unit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearspan.functions.times import epoch_micros
from wearspan.session import written

BLOCK = "_block"
HALO = "_halo"
OFFSET = "_offset"
LAST_KEY = "_last_key"


@dataclass(frozen=True)
class SplitPolicy:
    rows_per_block: int = 2_000_000
    max_split_entities: int = 5_000
    cells_per_block: int = 16

    @classmethod
    def of(cls, spark: SparkSession) -> SplitPolicy:
        """Defaults, with `spark.wearspan.rowsPerBlock` from the session when it is set."""
        rows = spark.conf.get("spark.wearspan.rowsPerBlock", None)
        return cls() if rows is None else cls(rows_per_block=int(rows))


@dataclass(frozen=True)
class BlockPlan:
    """How to cut the long series of one table; nothing to cut when `long_series` is None. `rows` is the table's size, 0 if
    nobody counted it."""

    entity: str
    key: Column
    long_series: DataFrame | None = None
    cells: DataFrame | None = None
    rows: int = 0

    @property
    def partition_keys(self) -> list[str]:
        return [self.entity] if self.long_series is None else [self.entity, BLOCK]


def order_key(df: DataFrame, column: str) -> Column:
    """The leading order column as a BIGINT."""
    kind = dict(df.dtypes)[column]
    if kind == "timestamp":
        return F.unix_micros(column)
    if kind == "timestamp_ntz":
        return epoch_micros(column)
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.col(column).cast("long")
    raise TypeError(f"blocks need an integer or timestamp order column, {column} is {kind}")


def plan_blocks(
    df: DataFrame,
    entity: str,
    order: str,
    halo: int = 0,
    policy: SplitPolicy | None = None,
) -> BlockPlan:
    """Check the series sizes and, if some series is long, cut it.

    `halo` is how many preceding rows a block must also see. It is counted in distinct key values,
    a lower bound of the rows, so the plan stays valid for `df` after exact duplicates are dropped.
    """
    policy = policy or SplitPolicy.of(df.sparkSession)
    key = order_key(df, order)
    sizes = df.groupBy(F.col(entity).alias("_e")).agg(F.count(F.lit(1)).alias("_n"))
    total, longest = sizes.agg(F.sum("_n"), F.max("_n")).first()
    if longest is None or longest <= policy.rows_per_block:
        return BlockPlan(entity, key, rows=total or 0)
    limit = max(policy.rows_per_block, -(-total // policy.max_split_entities))
    hot = sizes.filter(F.col("_n") > limit).select("_e")
    if hot.isEmpty():
        return BlockPlan(entity, key, rows=total)
    long_series, cells = _cut(df, entity, key, hot, limit, halo, policy)
    return BlockPlan(entity, key, long_series, cells, total)


def _cut(
    df: DataFrame,
    entity: str,
    key: Column,
    hot: DataFrame,
    limit: int,
    halo: int,
    policy: SplitPolicy,
) -> tuple[DataFrame, DataFrame]:
    keyed = df.select(F.col(entity).alias("_e"), key.alias("_k"))
    long_series = written(
        keyed.join(F.broadcast(hot), "_e")
        .groupBy("_e")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_k").alias("_low"), F.max("_k").alias(LAST_KEY))
        .withColumn(
            "_width",
            F.expr(f"({LAST_KEY} - _low) div ({policy.cells_per_block} * ceil(_n / {limit})) + 1"),
        )
        .select("_e", "_low", "_width", LAST_KEY),
        "long-series",
    )
    counted = (
        keyed.join(F.broadcast(long_series), "_e")
        .withColumn("_cell", _cell())
        .groupBy("_e", "_cell")
        .agg(F.count(F.lit(1)).alias("_weight"), F.countDistinct("_k").alias("_keys"))
    )
    series = Window.partitionBy("_e").orderBy("_cell")
    before = series.rowsBetween(Window.unboundedPreceding, -1)
    blocked = (
        counted.withColumn("_rows_before", F.coalesce(F.sum("_weight").over(before), F.lit(0)))
        .withColumn("_keys_before", F.coalesce(F.sum("_keys").over(before), F.lit(0)))
        .withColumn(BLOCK, F.expr(f"_rows_before div {limit}"))
        .withColumn(OFFSET, F.min("_rows_before").over(Window.partitionBy("_e", BLOCK)))
        .withColumn("_opens", F.col("_rows_before") == F.col(OFFSET))
    )
    if halo > 0:
        cells = _with_halo(blocked, halo)
    else:
        cells = blocked.withColumn("_targets", F.array(BLOCK))
    return long_series, written(cells.select("_e", "_cell", BLOCK, OFFSET, "_targets"), "cells")


def _cell() -> Column:
    return F.expr("(_k - _low) div _width")


def _with_halo(blocked: DataFrame, halo: int) -> DataFrame:
    """Add the later blocks that need a cell among their `halo` preceding keys.

    A block that opens after `p` keys needs a cell that ends after `q <= p` keys when fewer than
    `halo` keys lie between, that is `p - q < halo`: a range frame over key counts.
    """
    ends = blocked.withColumn("_at", F.col("_keys_before") + F.col("_keys")).withColumn(
        "_opener", F.lit(None).cast("long")
    )
    opens = (
        blocked.filter("_opens")
        .withColumn("_at", F.col("_keys_before"))
        .withColumn("_opener", F.col(BLOCK))
    )
    ahead = Window.partitionBy("_e").orderBy("_at").rangeBetween(0, halo - 1)
    return (
        ends.unionByName(opens)
        .withColumn("_later", F.collect_list("_opener").over(ahead))
        .filter(F.col("_opener").isNull())
        .withColumn("_targets", F.concat(F.array(BLOCK), "_later"))
    )


def route(df: DataFrame, plan: BlockPlan, with_halo: bool = False) -> DataFrame:
    """Prepare rows for windows over `plan.partition_keys`.

    Adds `_offset` (rows of the series before the block), `_last_key` (largest order key of a long
    series, NULL for the others), `_halo` (true for copies of preceding rows, made on request) and,
    when there is something to cut, `_block`.
    """
    if plan.long_series is None:
        return (
            df.withColumn(OFFSET, F.lit(0).cast("long"))
            .withColumn(LAST_KEY, F.lit(None).cast("long"))
            .withColumn(HALO, F.lit(False))
        )
    cells = plan.cells.withColumnRenamed("_e", "_ce").withColumnRenamed("_cell", "_cc")
    home = F.coalesce(BLOCK, F.lit(0)).cast("long")
    joined = (
        df.withColumn("_e", F.col(plan.entity))
        .withColumn("_k", plan.key)
        .join(F.broadcast(plan.long_series), "_e", "left")
        .withColumn("_cell", _cell())
        .join(
            F.broadcast(cells),
            (F.col("_e") == F.col("_ce")) & (F.col("_cell") == F.col("_cc")),
            "left",
        )
        .withColumn("_home", home)
        .withColumn(OFFSET, F.coalesce(OFFSET, F.lit(0)).cast("long"))
    )
    targets = F.coalesce("_targets", F.array("_home")) if with_halo else F.array("_home")
    return joined.withColumn("_to", F.explode(targets)).select(
        *[F.col(c) for c in df.columns],
        F.col("_to").alias(BLOCK),
        (F.col("_to") != F.col("_home")).alias(HALO),
        OFFSET,
        LAST_KEY,
    )


def drop_block_columns(df: DataFrame) -> DataFrame:
    return df.drop(BLOCK, HALO, OFFSET, LAST_KEY)
