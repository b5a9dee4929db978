"""Feature build: telemetry to window table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.operators.blocks import SplitPolicy
from wearspan.operators.contracts import LABELED_TELEMETRY, RAW_TELEMETRY, Contract, check
from wearspan.operators.labeling import (
    drop_duplicate_rows,
    drop_flat,
    feature_columns,
    label_telemetry,
)
from wearspan.operators.ranked import LongSeries, find_long_series
from wearspan.operators.sampling import select_engines
from wearspan.operators.windows import indexed_windows, require_windows, stamped_windows
from wearspan.params import JobParams
from wearspan.schemas import CYCLE, ENTITY, LINE_COLUMNS
from wearspan.session import written
from wearspan.sources.tables import write_manifest, write_windows
from wearspan.sources.text import read_telemetry

# A text line also has to have the right number of tokens.
TEXT_TELEMETRY = RAW_TELEMETRY.with_row_check(
    "line:token_count", lambda: F.col("token_count") == len(LINE_COLUMNS)
)


@dataclass(frozen=True)
class Features:
    """Indexed windows with their feature order."""

    windows: DataFrame
    names: list[str]


def clean_rows(
    raw: DataFrame,
    params: JobParams,
    contract: Contract = RAW_TELEMETRY,
    policy: SplitPolicy | None = None,
    long: LongSeries | None = None,
) -> DataFrame:
    """Contract, engine sample, labels, contract, deduplication, flat sensors.

    A caller that has checked the series sizes passes `long`; without a total in it, rows that come dealt out by engine stay as
    they lie.

    Deduplicated rows are written once: the flat-sensor pass, the engine sizes and the window build
    all read them, each with its own columns. The failures of both contracts are counted by that
    write. Only with an engine sample does the raw contract take a pass of its own, because it
    covers the engines left out as well.
    """
    checked = check(raw, contract)
    if params.max_engines and params.max_engines > 0:
        accepted, raw_watch = checked.enforce(), None
        accepted = select_engines(accepted, params.max_engines, params.seed)
        long = find_long_series(accepted, ENTITY, CYCLE, policy)
    else:
        long = long or find_long_series(checked.rows, ENTITY, CYCLE, policy)
        accepted, raw_watch = checked.observed()
    labeled = check(label_telemetry(accepted.drop("token_count"), long=long), LABELED_TELEMETRY)
    rows, watch = labeled.observed()
    deduplicated = written(drop_duplicate_rows(rows), "clean")
    if raw_watch is not None:
        checked.raise_for(raw_watch)
    labeled.raise_for(watch)
    return drop_flat(deduplicated)


def build_features(
    raw: DataFrame,
    params: JobParams,
    contract: Contract = RAW_TELEMETRY,
    policy: SplitPolicy | None = None,
    long: LongSeries | None = None,
) -> Features:
    clean = clean_rows(raw, params, contract, policy, long)
    names = feature_columns(clean)
    return Features(indexed_windows(_present(clean, names, contract), params.window_size, names, policy), names)


def _present(clean: DataFrame, names: list[str], contract: Contract) -> DataFrame:
    """Features that the contract has found present in every row, typed so: Spark reads every column of files as one that may be
    missing. The NaN is never taken, because the contract refuses NULL and NaN."""
    sure = {c for rule in contract.fields if rule.dtype == "double" and not rule.nullable for c in rule.columns(names)}
    return clean.withColumns({c: F.coalesce(c, F.lit(float("nan"))) for c in names if c in sure})


def write_features(
    raw: DataFrame,
    data_dir: str,
    params: JobParams,
    contract: Contract = RAW_TELEMETRY,
    as_of: datetime | None = None,
    long: LongSeries | None = None,
) -> str:
    """Build and publish the window table and its manifest; one clock reading per job."""
    spark = raw.sparkSession
    built = build_features(raw, params, contract, long=long)
    as_of = as_of or datetime.now(UTC).replace(tzinfo=None)
    stamped = stamped_windows(built.windows, as_of)
    path = write_windows(stamped, data_dir, params.window_size * len(built.names))
    require_windows(spark.read.parquet(path), params.window_size)
    write_manifest(spark, built.names, data_dir, path)
    return path


def prepare(
    spark: SparkSession,
    data_dir: str,
    params: JobParams,
    target: str | None = None,
    as_of: datetime | None = None,
) -> str:
    """From text files in `data_dir` to the window table in `target`."""
    return write_features(
        read_telemetry(spark, data_dir), target or data_dir, params, TEXT_TELEMETRY, as_of
    )
