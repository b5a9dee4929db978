"""Window table and feature manifest."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.operators.contracts import training_batch, check, windowed_features
from wearspan.schemas import MANIFEST, WINDOW_TABLE

WINDOWS = "engine_features.parquet"
VERSIONS = "engine_features"
NAMES = "feature_names.json"
# Written with this setting, a list without missing elements is one repeated value and no group around each.
PLAIN_LISTS = "spark.sql.parquet.writeLegacyFormat"
# Overlapping windows repeat byte by byte, which compression finds in plain values and not in numbers of a dictionary.
PLAIN_VALUES = {"parquet.enable.dictionary#windowed_features.array": "false"}


def write_windows(stamped: DataFrame, data_dir: str, expected_length: int) -> str:
    """Write a new version of the window table and check its contract in the same job.

    The failures are counted by the write itself, because building the windows a second time only
    to check them would double the most expensive step. Each version has a folder of its own. Only
    `write_manifest` publishes it, so after a failed run the former version stays the one that is read.
    """
    path = f"{data_dir}/{VERSIONS}/{uuid.uuid4().hex}"
    checked = check(stamped, windowed_features(expected_length))
    rows, watch = checked.observed()
    if stamped.schema["windowed_features"].dataType.containsNull:
        rows.write.parquet(path)
    else:
        with _setting(stamped.sparkSession, PLAIN_LISTS, "true"):
            rows.write.options(**PLAIN_VALUES).parquet(path)
    checked.raise_for(watch)
    return path


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for one write; what was set before comes back."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def manifest(spark: SparkSession, features: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(features)), MANIFEST)


def write_manifest(spark: SparkSession, features: list[str], data_dir: str, path: str | None = None) -> None:
    """Publish a version: one small file with the feature names and the folder written at `path`."""
    folder = F.lit(path.removeprefix(f"{data_dir}/") if path else WINDOWS)
    named = manifest(spark, features).withColumn("folder", folder)
    named.coalesce(1).write.mode("overwrite").json(f"{data_dir}/{NAMES}")


def read_manifest(spark: SparkSession, data_dir: str) -> DataFrame:
    return _read(
        lambda: spark.read.schema(MANIFEST).json(f"{data_dir}/{NAMES}"), f"{data_dir}/{NAMES}"
    )


def published_path(spark: SparkSession, data_dir: str) -> str:
    """Folder of the published version; a table without a manifest lies at its plain name."""
    try:
        published = spark.read.schema("folder string").json(f"{data_dir}/{NAMES}").first()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        published = None
    return f"{data_dir}/{(published and published['folder']) or WINDOWS}"


def feature_names(table: DataFrame) -> list[str]:
    return [r["feature"] for r in table.orderBy("position").collect()]  # one row per feature


def read_windows(spark: SparkSession, data_dir: str) -> DataFrame:
    """The published window table with the types of its files; an absent or empty one is an error."""
    path = published_path(spark, data_dir)
    rows = _read(lambda: spark.read.parquet(path), path)
    if rows.isEmpty():
        raise ValueError(f"the window table {path} is empty")
    return rows


def as_window_table(rows: DataFrame) -> DataFrame:
    """Rows that passed the batch contract in the one form that training uses: double readings are
    narrowed, wide labels too, zoned times become local ones, a missing creation time is NULL."""
    present = [f if f.name in rows.columns else None for f in WINDOW_TABLE]
    columns = [
        (F.col(f.name) if there else F.lit(None)).cast(f.dataType.simpleString()).alias(f.name)
        for f, there in zip(WINDOW_TABLE, present, strict=True)
    ]
    return rows.select(*columns)


def _read(load, path: str) -> DataFrame:
    try:
        return load()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        raise FileNotFoundError(f"{path} does not exist: run the feature build first") from error


def check_training_table(rows: DataFrame, features: list[str], window: int) -> DataFrame:
    """Batch contract plus the agreement of table, manifest and window.

    The expected length comes from the manifest, so a uniformly wrong table fails too. Columns and
    types are checked as they were read; what comes back has the types of a window table.
    """
    checked = check(rows, training_batch(window * len(features)))
    size = F.size("windowed_features")
    measured = checked.measure(F.min(size).alias("low"), F.max(size).alias("high"))
    low, high = measured["low"], measured["high"]
    for length in (low, high):
        if length is not None and length % window != 0:
            raise ValueError(f"array length {length} is not a multiple of the window {window}")
    if low is not None and low == high != window * len(features):
        raise ValueError(
            f"the manifest names {len(features)} features and the table has {low // window}"
        )
    checked.raise_for_counts(measured)
    return as_window_table(rows)
