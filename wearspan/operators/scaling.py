"""Scaler state over windows, computed without building the windows."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearspan.functions.scores import standardise
from wearspan.operators.blocks import OFFSET, SplitPolicy
from wearspan.operators.ranked import SIZE, split_by_rank
from wearspan.schemas import CYCLE, ENTITY
from wearspan.session import BROADCAST_ROWS, ship, written


def window_weight(position: Column, rows: Column, window: int) -> Column:
    """Windows that contain the row at 0-based `position` of a series with `rows` rows."""
    weight = F.least(position, rows - window) - F.greatest(F.lit(0), position - window + 1) + 1
    return F.when(rows >= window, weight).otherwise(F.lit(0))


WEIGHT = "_weight"


def weighted_rows(rows: DataFrame, features: list[str], window: int, policy: SplitPolicy | None = None) -> DataFrame:
    """The entity, the features as float32 values in doubles, and `_weight`, the windows that contain the row.

    Place and size of a series come from one window over it, which shares the shuffle of whatever else is keyed by the
    entity; a series above the block limit is cut by rank and brings both along.
    """
    order = [CYCLE, *features]
    narrow = rows.select(ENTITY, CYCLE, *[F.col(c).cast("float").cast("double").alias(c) for c in features])
    split = split_by_rank(narrow, ENTITY, order, policy=policy)
    series = Window.partitionBy(*split.keys)
    place = F.row_number().over(series.orderBy(*split.order)) + F.col(OFFSET) - 1
    size = F.coalesce(F.col(SIZE), F.count(F.lit(1)).over(series))
    placed = split.rows.withColumn("_place", place)  # first, so that the count finds its rows sorted
    return placed.select(ENTITY, *features, window_weight(F.col("_place"), size, window).alias(WEIGHT))


def moments_by_weight(weighted: DataFrame, features: list[str]) -> DataFrame:
    """Count, means and variances of the rows of each weight: at most `window` groups, merged from partial states map-side.

    Equal weights make the plain central moments, which Spark merges without cancellation, those of a weighted set.
    """
    return weighted.filter(F.col(WEIGHT) > 0).groupBy(WEIGHT).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.avg(c).alias(f"_m_{c}") for c in features],
        *[F.var_pop(c).alias(f"_v_{c}") for c in features],
    )


def fit_scaler(
    rows: DataFrame,
    features: list[str],
    window: int,
    engines: DataFrame | None = None,
    policy: SplitPolicy | None = None,
) -> DataFrame:
    """(position, feature, mean, std, n): moments over all rows of all windows, in one pass over the rows.

    A row counts once per window that contains it. Rows are grouped by that number, and the groups' moments, at most
    `window` of them, are put together here. Nothing is exploded and no series is collected. `engines` (the
    training engines) is counted and broadcast up to a bound; above it the join uses the partitioning that the rows already have.

    Values are narrowed to float32 first. The std is the population one.
    """
    weighted = weighted_rows(rows, features, window, policy)
    if engines is not None:
        wanted = written(engines.select(ENTITY).distinct(), "scaled-engines")
        if wanted.count() <= BROADCAST_ROWS:
            wanted = F.broadcast(wanted)
        weighted = weighted.join(wanted, ENTITY, "left_semi")
    groups = moments_by_weight(weighted, features).collect()  # one row per weight, `window` at most
    total = sum(g[WEIGHT] * g["_rows"] for g in groups)
    if not total:
        raise ValueError(f"no training engine has at least {window} cycles")
    state = []
    for position, c in enumerate(features):
        shares = [(g[WEIGHT] * g["_rows"] / total, g[f"_m_{c}"], g[f"_v_{c}"]) for g in groups]
        mean = math.fsum(s * m for s, m, _ in shares)
        variance = math.fsum(s * (v + (m - mean) ** 2) for s, m, v in shares)
        state.append((position, c, mean, variance**0.5, total))
    return rows.sparkSession.createDataFrame(
        state, "position int, feature string, mean double, std double, n long"
    )


@dataclass(frozen=True)
class ScalerState:
    """Scaler state as literals: one mean and std per feature."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    stds: tuple[float, ...]

    @classmethod
    def of(cls, table: DataFrame) -> ScalerState:
        rows = table.orderBy("position").collect()  # one row per feature
        return cls(
            tuple(r["feature"] for r in rows),
            tuple(r["mean"] for r in rows),
            tuple(r["std"] for r in rows),
        )

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """Means and divisors: a zero std divides by one."""
        stds = np.array(self.stds, dtype="<f8")
        return np.array(self.means, dtype="<f8"), np.where(stds == 0, 1.0, stds)

    def mean_array(self) -> Column:
        return F.array(*[F.lit(float(m)) for m in self.means])

    def std_array(self) -> Column:
        return F.array(*[F.lit(float(s)) for s in self.stds])


def scale_rows(rows: DataFrame, state: ScalerState) -> DataFrame:
    """Scale telemetry rows. Scaling commutes with windowing, so doing it here is `window` times
    cheaper than scaling windows."""
    scaled = {
        c: standardise(F.col(c).cast("float").cast("double"), F.lit(float(m)), F.lit(float(s))).cast("float")
        for c, m, s in zip(state.features, state.means, state.stds, strict=True)
    }
    return rows.withColumns(scaled)


def scale_rows_lazily(rows: DataFrame, scaler: DataFrame) -> DataFrame:
    """`scale_rows` with a scaler table kept lazy: each mean and std is a scalar subquery by name, the features those of the
    manifest of the scaler. A series is scaled before it is cut into windows, once a row and not once a window."""
    names = [r["feature"] for r in scaler.select("position", "feature").orderBy("position").collect()]  # one row per feature
    of = {c: scaler.filter(F.col("feature") == c) for c in names}
    # As columns first, so that a row of every subquery is read once and shared by all values.
    state = {f"_{k}_{c}": of[c].select(k).scalar() for c in names for k in ("mean", "std")}
    scaled = {
        c: standardise(F.col(c).cast("float").cast("double"), F.col(f"_mean_{c}"), F.col(f"_std_{c}")).cast("float")
        for c in names
    }
    return rows.withColumns(state).withColumns(scaled).drop(*state)


def scale_readings(readings: Column, state: ScalerState) -> Column:
    """Scale array<array<number>>; arithmetic in double, float32 out, same shape."""
    return F.transform(readings, lambda row: scale_flat(row, state))


def scale_flat(flat: Column, state: ScalerState) -> Column:
    """Scale a flat timestep-major array: value i belongs to feature i modulo width."""
    width = len(state.features)
    means, stds = state.mean_array(), state.std_array()
    return F.transform(
        flat,
        lambda x, i: standardise(
            x.cast("double"), F.get(means, i % width), F.get(stds, i % width)
        ).cast("float"),
    )


def scale_window_table(windows: DataFrame, state: ScalerState, column: str = "windowed_features") -> DataFrame:
    """`scale_flat` over a column of flat windows, batch by batch as arrays: the same arithmetic and the same float32 values."""
    means, stds = state.arrays()
    place = windows.columns.index(column)
    ship(windows.sparkSession)

    def scaled(batches):
        for batch in batches:
            yield scale_batch(batch, place, means, stds)

    typed = windows.withColumn(column, F.col(column).cast("array<float>"))
    return typed.mapInArrow(scaled, typed.schema)


def scale_batch(batch: pa.RecordBatch, place: int, means: np.ndarray, stds: np.ndarray) -> pa.RecordBatch:
    lists, width = batch.column(place), len(means)
    flat = lists.flatten()
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    values = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype("<f8")
    if len(sizes) and (sizes == sizes[0]).all() and sizes[0] % width == 0:
        with np.errstate(all="ignore"):
            out = ((values.reshape(-1, width) - means) / stds).astype("<f4").reshape(-1)
    else:
        feature = (np.arange(len(values)) - np.repeat(starts, sizes)) % width
        with np.errstate(all="ignore"):
            out = ((values - means[feature]) / stds[feature]).astype("<f4")
    missing = pc.is_null(flat).to_numpy(zero_copy_only=False) if flat.null_count else None
    whole = pa.array(out, pa.float32(), mask=missing)
    offsets = pa.array(np.append(starts, len(values)).astype("<i4"), pa.int32())
    column = pa.ListArray.from_arrays(offsets, whole, mask=pc.is_null(lists) if lists.null_count else None)
    arrays = [column if i == place else batch.column(i) for i in range(batch.num_columns)]
    return pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)


def scale_table(windows: DataFrame, scaler: DataFrame, column: str = "windowed_features") -> DataFrame:
    """Scale flat windows with a scaler table kept lazy: its arrays are two scalar subqueries."""
    ordered = scaler.agg(F.array_sort(F.collect_list(F.struct("position", "mean", "std"))).alias("s"))
    means = ordered.select(F.col("s.mean")).scalar()
    stds = ordered.select(F.col("s.std")).scalar()
    with_state = windows.withColumn("_means", means).withColumn("_stds", stds)
    width = F.size("_means")
    return with_state.withColumn(
        column,
        F.transform(
            F.col(column),
            lambda x, i: standardise(
                x.cast("double"), F.get("_means", i % width), F.get("_stds", i % width)
            ).cast("float"),
        ),
    ).drop("_means", "_stds")
