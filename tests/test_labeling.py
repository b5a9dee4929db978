from __future__ import annotations

import pytest
from helpers import TELEMETRY, one_engine
from pyspark.sql import functions as F

from wearspan.operators.contracts import RAW_TELEMETRY, ContractError, check
from wearspan.operators.labeling import (
    clean_telemetry,
    feature_columns,
    flat_sensors,
    label_telemetry,
)


def by_cycle(df, column):
    return [r[column] for r in df.orderBy("time_in_cycles").collect()]


def test_remaining_life_counts_down_to_the_last_cycle(spark):
    labeled = label_telemetry(one_engine(spark))
    assert by_cycle(labeled, "RUL") == [85, 83, 79, 0]
    assert by_cycle(labeled, "failure_type") == [0, 0, 0, 2]


@pytest.mark.parametrize(
    ("remaining", "expected"), [(0, 2), (30, 2), (31, 1), (60, 1), (61, 0), (500, 0)]
)
def test_class_bounds_are_inclusive(spark, remaining, expected):
    rows = [(1, c, 0.0, 0.0, 0.0, 0.0, 0.0, "FD001", "FD001_1") for c in (1, 1 + remaining)]
    labeled = label_telemetry(spark.createDataFrame(rows, TELEMETRY).distinct())
    assert by_cycle(labeled, "failure_type")[0] == expected


def test_cleaning_drops_flat_sensors_and_helpers(spark):
    clean = clean_telemetry(label_telemetry(one_engine(spark)))
    assert "sensor_1" in clean.columns
    assert not {"sensor_2", "RUL", "dataset_id"} & set(clean.columns)
    assert feature_columns(clean) == ["op_setting_1", "op_setting_2", "op_setting_3", "sensor_1"]


def test_exact_copies_disappear_and_near_copies_stay(spark):
    df = label_telemetry(one_engine(spark))
    copied = df.unionByName(df.limit(1)).unionByName(
        df.limit(1).withColumn("sensor_1", F.col("sensor_1") + 1)
    )
    assert clean_telemetry(copied).count() == 5


def test_undefined_spread_keeps_the_sensor(spark):
    assert flat_sensors(one_engine(spark).limit(1)) == []


def test_integer_sensor_is_coerced(spark):
    df = one_engine(spark).withColumn("sensor_1", F.lit(3))
    checked = check(df, RAW_TELEMETRY)
    assert dict(checked.enforce().dtypes)["sensor_1"] == "double"


@pytest.mark.parametrize(
    ("column", "value", "broken"),
    [
        ("sensor_1", None, "sensor_1:not_null"),
        ("sensor_1", float("nan"), "sensor_1:not_null"),
        ("sensor_1", 1e6, "sensor_1:magnitude"),
        ("sensor_1", float("-inf"), "sensor_1:magnitude"),
        ("unit_number", 0, "unit_number:greater_than_0"),
        ("global_unit", None, "global_unit:not_null"),
    ],
)
def test_bad_values_are_named(spark, column, value, broken):
    kind = dict(one_engine(spark).dtypes)[column]
    df = one_engine(spark).withColumn(
        column, F.when(F.col("time_in_cycles") == 5, F.lit(value).cast(kind)).otherwise(F.col(column))
    )
    with pytest.raises(ContractError) as error:
        check(df, RAW_TELEMETRY).enforce()
    assert error.value.counts == {broken: 1}


def test_missing_columns_raise_before_any_row_is_read(spark):
    with pytest.raises(ContractError) as error:
        check(one_engine(spark).drop("sensor_1", "sensor_2", "dataset_id"), RAW_TELEMETRY)
    assert set(error.value.counts) == {r"sensor_\d+:present", "dataset_id:present"}
