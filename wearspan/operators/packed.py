"""Windows packed by their common steps, and passes over them in arrays.

Windows of stride one share all steps but one with the window before. A packed table holds such steps once: a record has a list of
steps and, for every window of it, where the window starts in that list. Steps are shared only where the engine is the same, the
position is the next one and all bits agree, so any window table can be packed and read back whole; in one that does
not lie in order nothing is shared. A record holds about `RECORD_VALUES` values, or four windows, whatever the engines are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearspan.operators.scaling import ScalerState
from wearspan.schemas import LABEL
from wearspan.session import ship

RECORD_VALUES = 2_048
# Values that a task unpacks at once.
BLOCK_VALUES = 262_144
PACKED = "engines array<string>, positions array<long>, labels array<int>, starts array<int>, size int, `values` array<float>, part string"


def pack_windows(
    windows: DataFrame, width: int, position: str | None = None, values: str = "windowed_features", by: str | None = None
) -> DataFrame:
    """Records of windows whose flat values have `width` values a step: engines, positions and labels by window, `starts` of the
    windows in the record's `values`, `size` as the number of a window's values, and `part`, the text of the column `by`, which all
    windows of a record share.

    Columns that the windows lack are NULL. Values are narrowed to float32.
    """

    def column(name: str | None, dtype: str):
        return (F.col(name) if name in windows.columns else F.lit(None)).cast(dtype)

    rows = windows.select(
        column("engine_id", "string").alias("engine"),
        column(position, "long").alias("position"),
        column(LABEL, "int").alias("label"),
        column(by, "string").alias("part"),
        F.col(values).cast("array<float>").alias("values"),
    )
    ship(windows.sparkSession)

    def packed(batches):
        for batch in batches:
            yield from pack_batch(batch, width)

    return rows.mapInArrow(packed, PACKED)


def pack_batch(batch: pa.RecordBatch, width: int) -> Iterator[pa.RecordBatch]:
    """Windows (engine, position, label, part, values) of one Arrow batch as records, a batch for every size and part."""
    sizes = pc.fill_null(pc.list_value_length(batch.column(4)), 0).to_numpy(zero_copy_only=False)
    parts = pc.fill_null(batch.column(3).dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
    groups = np.unique(np.stack([sizes, parts]), axis=1).T
    for size, part in groups.tolist():
        at = np.flatnonzero((sizes == size) & (parts == part))
        yield _records(batch if len(at) == batch.num_rows else batch.take(pa.array(at)), size, width)


def _records(batch: pa.RecordBatch, size: int, width: int) -> pa.RecordBatch:
    n, steps = batch.num_rows, -(-size // width)
    flat = batch.column(4).flatten()
    numbers = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype("<f4", copy=False).reshape(n, size)
    missing = pc.is_null(flat).to_numpy(zero_copy_only=False).reshape(n, size) if flat.null_count else None
    if size % width:  # broken windows begin at a step of their own too
        fill = ((0, 0), (0, steps * width - size))
        numbers = np.pad(numbers, fill)
        missing = None if missing is None else np.pad(missing, fill)
    follows = np.zeros(n, dtype=bool)
    if n > 1 and size and size % width == 0:
        engines = pc.fill_null(batch.column(0).dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
        bits = numbers.view("<u4")
        same = (bits[1:, : size - width] == bits[:-1, width:]).all(axis=1) & (engines[1:] == engines[:-1])
        if missing is not None:
            same &= (missing[1:, : size - width] == missing[:-1, width:]).all(axis=1)
        places = batch.column(1)
        if places.null_count < n:
            known = pc.is_valid(places).to_numpy(zero_copy_only=False)
            number = pc.fill_null(places, 0).to_numpy(zero_copy_only=False)
            same &= known[1:] & known[:-1] & (number[1:] == number[:-1] + 1)
        follows[1:] = same
    record = np.cumsum(np.where(follows, width, max(steps * width, 1))) // max(RECORD_VALUES, 4 * size)
    first = np.append(True, record[1:] != record[:-1])
    follows &= ~first
    ends = np.cumsum(np.where(follows, 1, steps))
    begins = np.flatnonzero(first)
    offset = np.append(0, ends)[begins]  # steps before each record
    starts = (ends - steps - np.repeat(offset, np.diff(np.append(begins, n)))) * width
    kept = np.ones(numbers.shape, dtype=bool)
    kept[follows, : (steps - 1) * width] = False
    windows = pa.array(np.append(begins, n).astype("<i4"))
    whole = pa.array(numbers[kept], pa.float32(), mask=None if missing is None else missing[kept])
    lists = [pa.ListArray.from_arrays(windows, c) for c in (*(batch.column(i) for i in range(3)), pa.array(starts.astype("<i4")))]
    values = pa.ListArray.from_arrays(pa.array((np.append(offset, ends[-1]) * width).astype("<i4")), whole)
    fixed = [pa.array(np.full(len(begins), size, dtype="<i4")), values, batch.column(3).take(pa.array(begins))]
    return pa.RecordBatch.from_arrays([*lists, *fixed], names=["engines", "positions", "labels", "starts", "size", "values", "part"])


def blocks(batch: pa.RecordBatch, state: ScalerState | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(labels, starts, values) of a few records at a time: labels as numbers, NaN where missing, starts of the windows in the flat float64
    values, scaled with `state` as whole tables are, 0 where missing."""
    at = {name: batch.schema.get_field_index(name) for name in ("labels", "starts", "values")}
    lengths = pc.list_value_length(batch.column(at["values"])).to_numpy(zero_copy_only=False)
    windows = pc.list_value_length(batch.column(at["starts"])).to_numpy(zero_copy_only=False)
    sizes = batch.column(batch.schema.get_field_index("size")).to_numpy(zero_copy_only=False)
    share = np.cumsum(windows * np.maximum(sizes, 1)) // BLOCK_VALUES
    edges = np.flatnonzero(np.append(True, share[1:] != share[:-1]))
    for low, high in zip(edges.tolist(), [*edges[1:].tolist(), batch.num_rows], strict=True):
        labels, starts, flat = (batch.column(at[name]).slice(low, high - low).flatten() for name in ("labels", "starts", "values"))
        values = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype("<f8")
        if state is not None:
            means, stds = state.arrays()
            with np.errstate(all="ignore"):
                scaled = (values.reshape(-1, len(stds)) - means) / stds
                values = scaled.astype("<f4").astype("<f8").reshape(-1)
            if flat.null_count:
                values[pc.is_null(flat).to_numpy(zero_copy_only=False)] = 0.0
        before = np.cumsum(lengths[low:high]) - lengths[low:high]
        moved = starts.to_numpy(zero_copy_only=False) + np.repeat(before, windows[low:high])
        numbers = pc.cast(labels, pa.float64()).to_numpy(zero_copy_only=False)
        yield numbers, moved, values


def unpacked(starts: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Windows by values."""
    return np.lib.stride_tricks.sliding_window_view(values, size)[starts]


def window_size(packed: DataFrame) -> int:
    """The number of values that every window has; windows of several sizes are an error."""
    row = packed.agg(F.min("size").alias("low"), F.max("size").alias("high")).first()
    if row["low"] is None:
        raise ValueError("there is no window")
    if row["low"] != row["high"]:
        raise ValueError(f"windows have {row['low']} to {row['high']} values")
    return row["low"]


def merged_moments(a: tuple, b: tuple) -> tuple:
    """Weight, mean and summed squared deviations of two sets together."""
    (wa, ma, sa), (wb, mb, sb) = a, b
    both = wa + wb
    if not both:
        return a
    apart = mb - ma
    return both, ma + apart * (wb / both), sa + sb + apart**2 * (wa * wb / both)


def step_moments(batches: Iterator[pa.RecordBatch], width: int) -> tuple | None:
    """Count, means and summed squared deviations of the features over all steps of all windows; None without windows."""
    found = None
    for batch in batches:
        size = batch.column(batch.schema.get_field_index("size")).to_numpy(zero_copy_only=False)
        if (size != size[0]).any() or size[0] % width:
            raise ValueError(f"windows need equally many steps of {width} values")
        for _, starts, values in blocks(batch, None):
            rows = values.reshape(-1, width)
            held = np.zeros(len(rows) + 1)
            np.add.at(held, starts // width, 1.0)
            np.add.at(held, (starts + size[0]) // width, -1.0)
            times = np.cumsum(held[:-1])
            total = times.sum()
            if not total:
                continue
            with np.errstate(all="ignore"):
                apart = rows - rows[0]  # exactly zero where a value is constant
                middle = times @ apart / total
                part = total, rows[0] + middle, times @ (apart - middle) ** 2
            found = part if found is None else merged_moments(found, part)
    return found
