"""Small helpers shared by the operators: fresh column names, shared tables, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from wearspan.session import scratch_path, ship  # noqa: F401 (operators import it from here)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """`name`, or `name` with underscores, so that it clashes with no column of `df`."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def saved(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write once to the shared folder and read back; the rows then survive lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chunks(batch: pa.RecordBatch, column: str, limit: int = 4_000_000) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Slices of a batch with the texts of `column`, each of about `limit` bytes or one row."""
    values = batch.column(column)
    start = 0
    while start < batch.num_rows:
        end, size = start, 0
        while end < batch.num_rows and (end == start or size < limit):
            value = values[end]
            size += 16 + (len(value.as_buffer()) if value.is_valid else 0)
            end += 1
        part = batch.slice(start, end - start)
        yield part, part.column(column).to_pylist()
        start = end
