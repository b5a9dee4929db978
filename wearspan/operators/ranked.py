"""Cutting long series by rank, so that every block has the same number of rows whatever the keys are.

`Window.partitionBy(entity)` sends a whole series to one task. Here the rows of series above `rows_per_block` are dealt into
ranges of (entity, order columns, row) and numbered: the rank of a row is its number inside its range plus the sizes of the
series' earlier ranges. A block is `rows_per_block` consecutive ranks; on request it also receives the rows just before it. Outlier
keys, bursts and equal keys change nothing, because ranks and not keys are cut, and equal rows are told apart by their place
in the input. All other series keep block 0 and are not touched by this.

The cost is one range shuffle and one numbering of the long series' rows, which are written in between: the ranges must be
the same for both passes even when a task is run again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearspan.operators.blocks import BLOCK, HALO, OFFSET, SplitPolicy
from wearspan.session import BROADCAST_ROWS, spread, written

RANK = "_rank"
SIZE = "_n"
RANGES_PER_BLOCK = 2


@dataclass(frozen=True)
class LongSeries:
    """The series above the limit: `_e`, `_n` (rows) and `_last` (largest order key), written; None without any. `rows` are
    theirs, `total` those of all series, 0 if nobody counted them."""

    table: DataFrame | None
    rows: int = 0
    limit: int = 0
    total: int = 0

    @property
    def hinted(self) -> DataFrame:
        """For joins: broadcast as long as its counted size allows it."""
        return F.broadcast(self.table) if self.table.count() <= BROADCAST_ROWS else self.table


def find_long_series(df: DataFrame, entity: str, order: str, policy: SplitPolicy | None = None) -> LongSeries:
    """Check the sizes of the series with one aggregate over the entity column alone; the order column is only read when some
    series is long.

    The limit is fixed and does not grow with the table. A NULL entity is a series like any other.
    """
    policy = policy or SplitPolicy.of(df.sparkSession)
    long = F.col("_n") > policy.rows_per_block
    series = df.groupBy(F.col(entity).alias("_e"))
    sizes = series.agg(F.count(F.lit(1)).alias("_n"))
    rows, total = sizes.agg(F.sum(F.when(long, F.col("_n"))), F.coalesce(F.sum("_n"), F.lit(0))).first()
    if rows is None:
        return LongSeries(None, total=total)
    ends = series.agg(F.count(F.lit(1)).alias("_n"), F.max(order).alias("_last"))
    return LongSeries(written(ends.filter(long), "long-series"), rows, policy.rows_per_block, total)


def same_entity(entity: str) -> Column:
    return F.col(entity).eqNullSafe(F.col("_e"))


def ranked_rows(df: DataFrame, entity: str, order_by: list[str], long: LongSeries) -> DataFrame:
    """The rows of the long series with `_rank` (1-based in the series) and `_n`, the series' rows."""
    rows = df.join(long.hinted.select("_e", "_n"), same_entity(entity)).drop("_e")
    ranges = max(2, -(-long.rows * RANGES_PER_BLOCK // long.limit))
    ranged = written(
        rows.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(ranges, entity, *order_by, "_tie")
        .withColumn("_range", F.spark_partition_id()),
        "ranged",
    )
    counts = ranged.groupBy(F.col(entity).alias("_e"), F.col("_range").alias("_r")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per range, and one more for each series that begins inside a range.
    earlier = Window.partitionBy("_e").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    shifts = written(counts.select("_e", "_r", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_shift")), "range-shifts")
    if shifts.count() <= BROADCAST_ROWS:
        shifts = F.broadcast(shifts)
    inside = Window.partitionBy("_range", entity).orderBy(*order_by, "_tie")
    numbered = ranged.withColumn("_inside", F.row_number().over(inside))
    joined = numbered.join(shifts, same_entity(entity) & (F.col("_range") == F.col("_r")))
    return joined.withColumn(RANK, (F.col("_inside") + F.col("_shift")).cast("long")).drop("_e", "_r", "_range", "_tie", "_shift", "_inside")


@dataclass(frozen=True)
class SplitRows:
    """Rows with `_block`, `_halo`, `_offset` (the series' rows before the block), `_rank` and `_n` (the series' rows; both
    NULL in series that were not cut), and the keys and order that their windows take. `total` counts the rows before any copies."""

    rows: DataFrame
    keys: list[str]
    order: list[str]
    total: int = 0

    @property
    def dealt(self) -> DataFrame:
        """The rows by their keys, for windows over rows that no earlier step has dealt out."""
        return spread(self.rows, self.total, *self.keys)


def split_by_rank(
    df: DataFrame,
    entity: str,
    order_by: list[str],
    halo: int = 0,
    policy: SplitPolicy | None = None,
    long: LongSeries | None = None,
) -> SplitRows:
    """Prepare rows for windows over (entity, block). `halo` preceding rows of the series come with each block as copies.

    `df` is read twice when there is something to cut. The copies of a row go to all blocks that need it, also when
    the halo is longer than a block.
    """
    long = long or find_long_series(df, entity, order_by[0], policy)
    if long.table is None:
        plain = df.withColumn(OFFSET, F.lit(0).cast("long")).withColumn(HALO, F.lit(False)).withColumns({c: F.lit(None).cast("long") for c in (RANK, SIZE)})
        return SplitRows(plain, [entity], order_by, long.total)
    limit = F.lit(long.limit).cast("long")
    ranked = ranked_rows(df, entity, order_by, long)
    home = F.floor((F.col(RANK) - 1) / limit).cast("long")
    furthest = F.least(F.floor((F.col(RANK) - 1 + halo) / limit), F.floor((F.col("_n") - 1) / limit)).cast("long")
    hot = ranked.withColumn("_home", home).withColumn(BLOCK, F.explode(F.sequence("_home", furthest)))
    hot = hot.withColumn(HALO, F.col(BLOCK) != F.col("_home")).withColumn(OFFSET, F.col(BLOCK) * limit)
    rest = df.join(long.hinted.select("_e"), same_entity(entity), "left_anti")
    rest = rest.withColumn(BLOCK, F.lit(0).cast("long")).withColumn(HALO, F.lit(False)).withColumn(OFFSET, F.lit(0).cast("long"))
    rest = rest.withColumns({c: F.lit(None).cast("long") for c in (RANK, SIZE)})
    columns = [*df.columns, BLOCK, HALO, OFFSET, RANK, SIZE]
    return SplitRows(rest.select(*columns).unionByName(hot.select(*columns)), [entity, BLOCK], [RANK, *order_by], long.total)


def per_block(table: DataFrame, entity: str, long: LongSeries) -> DataFrame:
    """A table of one row per series, for joins by the keys of `split_by_rank`: the row of a long series is repeated for each of its blocks."""
    if long.table is None:
        return table
    known = table.join(long.hinted.select("_e", "_n"), same_entity(entity), "left").drop("_e")
    last = F.coalesce(F.floor((F.col("_n") - 1) / F.lit(long.limit).cast("long")), F.lit(0)).cast("long")
    return known.withColumn(BLOCK, F.explode(F.sequence(F.lit(0).cast("long"), last))).drop("_n")
