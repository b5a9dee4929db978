from __future__ import annotations

from datetime import datetime

import pytest
from helpers import one_engine
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearspan.operators.contracts import (
    LABELED_TELEMETRY,
    Contract,
    ContractError,
    Field,
    check,
    custom,
    request_reason,
    training_batch,
    windowed_features,
)
from wearspan.operators.scoring import accepted_and_rejected
from wearspan.schemas import READINGS, WINDOW_TABLE

NOW = datetime(2024, 1, 1)


def window_table(spark, *rows):
    return spark.createDataFrame(
        [(name, NOW, NOW, values, label) for name, values, label in rows], WINDOW_TABLE
    )


def labeled(spark, classes):
    rows = one_engine(spark).filter("time_in_cycles < 20").withColumn("RUL", F.lit(5).cast("long"))
    place = F.array_position(F.array(*map(F.lit, (3, 5, 9))), F.col("time_in_cycles").cast("int")).cast("int")
    return rows.withColumn("failure_type", F.element_at(F.array(*map(F.lit, classes)), place))


def test_classes_outside_the_domain_are_refused(spark):
    check(labeled(spark, [0, 1, 2]), LABELED_TELEMETRY).enforce()
    with pytest.raises(ContractError, match="failure_type"):
        check(labeled(spark, [0, 0, 9]), LABELED_TELEMETRY).enforce()


def test_window_length_and_identifier(spark):
    good = window_table(spark, ("a", [1.0] * 4, 0), ("b", [2.0] * 4, 2))
    assert check(good, windowed_features(4)).enforce().count() == 2
    short = window_table(spark, ("a", [1.0] * 4, 0), ("b", [2.0] * 3, 2))
    with pytest.raises(ContractError) as error:
        check(short, windowed_features(4)).enforce()
    assert error.value.counts == {"windowed_features:length": 1}
    with pytest.raises(ContractError, match="engine_id:length"):
        check(window_table(spark, ("", [1.0] * 4, 0)), windowed_features(4)).enforce()


def test_all_failures_are_found_before_raising(spark):
    bad = window_table(spark, ("", [1.0] * 3, 7), ("x", [1.0] * 4, 7))
    with pytest.raises(ContractError) as error:
        check(bad, windowed_features(4)).enforce()
    assert error.value.counts == {
        "engine_id:length": 1,
        "windowed_features:length": 1,
        "failure_type:one_of_0_1_2": 2,
    }


def test_training_batch_takes_any_timestamp_but_not_text(spark):
    rows = window_table(spark, ("a", [1.0] * 4, 0)).drop("created_timestamp")
    check(rows, training_batch(4)).enforce()
    zoned = rows.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    check(zoned, training_batch(4)).enforce()
    with pytest.raises(ContractError, match="created_timestamp:present"):
        check(rows, windowed_features(4))
    with pytest.raises(ContractError, match="event_timestamp:type string"):
        check(rows.withColumn("event_timestamp", F.lit("today")), training_batch(4))


def test_counts_can_ride_on_a_write(spark, tmp_path):
    bad = check(window_table(spark, ("", [1.0] * 4, 0)), windowed_features(4))
    rows, watch = bad.observed()
    rows.write.parquet(str(tmp_path / "out"))
    with pytest.raises(ContractError, match="engine_id:length: 1"):
        bad.raise_for(watch)


def test_quarantine_splits_without_loss(spark):
    df = spark.range(100).withColumn("v", F.col("id") % 7)
    checked = check(df, Contract("c", (Field("v", checks=(custom("small", lambda c: c < 5),)),)))
    assert checked.good().count() + checked.bad().count() == 100
    assert checked.failure_cases().filter("check = 'v:small'").count() == checked.bad().count()


REQUESTS = [
    ("ENG_001", [[1.0, 2.0]] * 3, None),
    (" padded ", [[1.0, 2.0]] * 3, None),
    ("x", [[1.0, 2.0], [1.0], [1.0, 2.0]], "readings not rectangular at row 1"),
    ("x", [[]], "readings row 0 empty"),
    ("x", [], "readings missing"),
    ("x", None, "readings missing"),
    ("x", [[1.0, 2.0], [float("nan"), 2.0]], "readings not finite at row 1"),
    ("x", [[float("inf"), 2.0]], "readings not finite at row 0"),
    ("   ", [[1.0]], "engine_id blank"),
    ("", [[1.0]], "engine_id length"),
    ("e" * 65, [[1.0]], "engine_id length"),
]


@pytest.mark.parametrize(("engine", "readings", "reason"), REQUESTS)
def test_request_reasons(spark, engine, readings, reason):
    schema = T.StructType(
        [T.StructField("engine_id", T.StringType()), T.StructField("readings", READINGS)]
    )
    df = spark.createDataFrame([(engine, readings)], schema)
    assert df.select(request_reason()).first()[0] == reason
    good, bad = accepted_and_rejected(df, len(readings or []), len((readings or [[]])[0]) if readings else 0)
    assert (good.count(), bad.count()) == ((1, 0) if reason is None else (0, 1))


def test_shape_is_checked_against_the_model(spark):
    df = spark.createDataFrame([("x", [[1.0, 2.0]] * 4)], "engine_id string, readings array<array<double>>")
    good, bad = accepted_and_rejected(df, 4, 3)
    assert good.count() == 0
    assert bad.first()["reasons"] == "readings:shape"
    assert good.columns == ["engine_id", "readings"]
