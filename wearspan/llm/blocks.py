"""Pairs of rows within hot groups, without one task holding a group.

A group of n members is cut by hash into ceil(n / block) blocks, every two blocks meet in one unit of
work, and the units are spread by hash and streamed in order, so that a task holds two blocks at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def crowded(spread: DataFrame, block: int) -> DataFrame:
    """Members (key, node) of keys with more than one member, with the number of blocks and their own."""
    sizes = spread.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    count = F.ceil(F.col("n") / block)
    return spread.join(sizes, "key").select("key", "node", count.alias("count"), F.pmod(F.xxhash64("node", "key"), count).alias("block"))


def meetings(members: DataFrame) -> DataFrame:
    """Members copied to every unit (key, lo, hi) that their block takes part in, in order of the units."""
    ends = F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1))
    rest = [c for c in members.columns if c not in ("key", "count", "block")]
    units = members.select("*", ends.alias("other")).select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", *rest)
    return units.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")


def column_values(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A column as an array; lists of one length as its rows."""
    column = batch.column(name)
    if pa.types.is_list(column.type):
        return column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    return column.to_numpy(zero_copy_only=False)


def units(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, bool, dict[str, np.ndarray]]]:
    """(left rows, right rows, whether both are one block, columns) of each unit, also across batches."""
    held: list[dict[str, np.ndarray]] = []
    current = None

    def unit() -> tuple[np.ndarray, np.ndarray, bool, dict[str, np.ndarray]]:
        columns = {n: np.concatenate([h[n] for h in held]) for n in (*names, "block")}
        inner = current[1] == current[2]
        left = np.flatnonzero(columns["block"] == current[1])
        return left, left if inner else np.flatnonzero(columns["block"] == current[2]), inner, columns

    for batch in batches:
        key, lo, hi = (batch.column(c).to_numpy() for c in ("key", "lo", "hi"))
        columns = {n: column_values(batch, n) for n in (*names, "block")}
        change = np.flatnonzero((key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
        for start, end in zip(np.r_[0, change], np.r_[change, len(key)], strict=True):
            if start == end:
                continue
            name = (key[start], lo[start], hi[start])
            if name != current:
                if held:
                    yield unit()
                held, current = [], name
            held.append({n: c[start:end] for n, c in columns.items()})
    if held:
        yield unit()
