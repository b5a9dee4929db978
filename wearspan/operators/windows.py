"""Count-based sliding windows per engine."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wearspan.functions.arrays import float_vector
from wearspan.functions.times import wall_clock
from wearspan.operators.blocks import (
    HALO,
    OFFSET,
    BlockPlan,
    SplitPolicy,
    route,
)
from wearspan.operators.labeling import feature_columns
from wearspan.operators.ordinals import running_offsets
from wearspan.operators.ranked import find_long_series, per_block, split_by_rank
from wearspan.schemas import CYCLE, ENTITY, LABEL
from wearspan.session import BROADCAST_ROWS, tasks_for, written


def order_columns(features: list[str]) -> list[str]:
    """Cycle first; rows of the same cycle are ordered by their readings."""
    return [CYCLE, *features]


def sliding_windows(
    df: DataFrame,
    window: int,
    features: list[str] | None = None,
    policy: SplitPolicy | None = None,
    plan: BlockPlan | None = None,
) -> DataFrame:
    """One row per full window of `window` consecutive rows of an engine, stride 1.

    Long engines are cut by rank, so `df` is then read twice; with a `plan` they are cut along its keys.

    Columns: `engine_id`, `end_cycle`, `readings` (array of float32 arrays, oldest row first) and
    `failure_type` of the last row. Engines shorter than the window give nothing.
    """
    features = features or feature_columns(df)
    routed, spec = _series(df, window, features, policy, plan)
    frame = spec.rowsBetween(1 - window, Window.currentRow)
    # A frame is full from the row with that number on; nothing then needs the readings but who reads them.
    framed = routed.withColumn("_row", F.row_number().over(spec)).withColumn(
        "readings", F.collect_list(float_vector(features)).over(frame)
    ).filter((F.col("_row") >= window) & ~F.col(HALO))
    return framed.select(
        F.col(ENTITY).alias("engine_id"),
        F.col(CYCLE).alias("end_cycle"),
        "readings",
        F.col(LABEL).cast("int").alias(LABEL),
    )


def stepped_windows(
    df: DataFrame,
    window: int,
    features: list[str],
    policy: SplitPolicy | None = None,
    plan: BlockPlan | None = None,
) -> DataFrame:
    """The windows of `sliding_windows` with a column for every value in place of `readings`: `step_column(step, feature)`,
    oldest step first, with the types of `df`. What is computed over them is compiled, a lambda over an array is not."""
    routed, spec = _series(df, window, features, policy, plan)
    values = {step_column(i, c): F.lag(c, window - 1 - i).over(spec) for i in range(window) for c in features}
    # The lags take names of their own in one projection, so that they share one sorted pass.
    framed = routed.withColumns({"_row": F.row_number().over(spec), **values})
    return framed.filter((F.col("_row") >= window) & ~F.col(HALO)).select(
        F.col(ENTITY).alias("engine_id"), F.col(CYCLE).alias("end_cycle"), F.col(LABEL).cast("int").alias(LABEL), *values
    )


def step_column(step: int, feature: str) -> str:
    return f"_{step}_{feature}"


def _series(
    df: DataFrame, window: int, features: list[str], policy: SplitPolicy | None, plan: BlockPlan | None
) -> tuple[DataFrame, WindowSpec]:
    """Rows with their halo marks, and the partitions and order in which they form windows."""
    rows = df.select(ENTITY, CYCLE, LABEL, *features)
    if plan is None:
        split = split_by_rank(rows, ENTITY, order_columns(features), window - 1, policy)
        routed, keys, order = split.dealt, split.keys, split.order
    else:
        routed, keys, order = route(rows, plan, with_halo=True), plan.partition_keys, order_columns(features)
    return routed, Window.partitionBy(*keys).orderBy(*order)


def require_windows(windows: DataFrame, window: int) -> DataFrame:
    """Refuse a result in which no engine reached the window length."""
    if windows.isEmpty():
        raise ValueError(f"no engine has at least {window} cycles, so there are no windows")
    return windows


def window_counts(df: DataFrame, window: int) -> DataFrame:
    """Windows per engine, known from the row counts alone."""
    return df.groupBy(ENTITY).agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "windows", F.greatest(F.lit(0), F.col("rows") - window + 1).cast("long")
    )


def flatten_window(readings: Column) -> Column:
    """Timestep-major flat array."""
    return F.flatten(readings)


def indexed_windows(
    clean: DataFrame,
    window: int,
    features: list[str] | None = None,
    policy: SplitPolicy | None = None,
) -> DataFrame:
    """`sliding_windows` plus `window_index` (0-based in the engine) and `global_index`
    (0-based over engines in lexical order).

    `clean` is scanned more than once (block plan, engine sizes, rows), so it should be a written
    table. The rows are shuffled once, however many engines there are; those of long engines once more, to be ranked.
    """
    features = features or feature_columns(clean)
    columns = [ENTITY, CYCLE, LABEL, *features]
    rows = clean.select(*columns)
    counts = window_counts(rows, window).filter("windows > 0")
    starts = running_offsets(counts, ENTITY, "windows").select(
        ENTITY, F.col("offset").alias("_start")
    )
    long = find_long_series(rows, ENTITY, CYCLE, policy)
    # Joined to the rows, not to the windows, which are `window` times as wide.
    few = starts.count() <= BROADCAST_ROWS
    started = rows.join(F.broadcast(starts), ENTITY) if few else rows
    split = split_by_rank(started, ENTITY, order_columns(features), window - 1, long=long)
    # Windows are `window` times larger than their rows, which adaptive coalescing cannot see: an
    # explicit partition count keeps the configured parallelism, or more for many rows. It is the only shuffle of the rows.
    routed = split.rows.repartition(tasks_for(clean.sparkSession, split.total), *split.keys)
    if not few:
        # Many engines go to where their rows are dealt; a join before that would deal the rows by the configured number.
        routed = routed.join(per_block(starts, ENTITY, long).hint("shuffle_hash"), split.keys)
    spec = Window.partitionBy(*split.keys).orderBy(*split.order)
    frame = spec.rowsBetween(1 - window, Window.currentRow)
    # Halo rows precede the block's own rows, so the running count of own rows is the position.
    position = F.sum((~F.col(HALO)).cast("long")).over(spec.rowsBetween(Window.unboundedPreceding, 0)) + F.col(OFFSET)
    framed = routed.withColumn("window_index", position - window).withColumn(
        "readings", F.collect_list(float_vector(features)).over(frame)
    ).filter((F.col("window_index") >= 0) & ~F.col(HALO))
    return framed.select(
        F.col(ENTITY).alias("engine_id"),
        F.col(CYCLE).alias("end_cycle"),
        "window_index",
        (F.col("_start") + F.col("window_index")).alias("global_index"),
        "readings",
        F.col(LABEL).cast("int").alias(LABEL),
    )


def stamped_windows(indexed: DataFrame, as_of: datetime) -> DataFrame:
    """Window table rows: flat features and bookkeeping timestamps.

    Event time is `as_of` minus 23 hours plus ten seconds per global index.
    """
    created = wall_clock(as_of)
    base = created - F.expr("INTERVAL 23 HOURS")
    return indexed.select(
        "engine_id",
        (base + F.make_dt_interval(secs=(F.col("global_index") * 10).cast("decimal(18,6)"))).alias(
            "event_timestamp"
        ),
        created.alias("created_timestamp"),
        flatten_window(F.col("readings")).alias("windowed_features"),
        LABEL,
    )


def written_rows(df: DataFrame) -> DataFrame:
    """Cut a cleaned table's lineage before the passes of `indexed_windows`."""
    return written(df, "clean")
