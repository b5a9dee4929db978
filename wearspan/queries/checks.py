"""Contracts over telemetry with deterministic damage."""

from __future__ import annotations

from pyspark.sql import functions as F

from wearspan.functions.arrays import is_finite
from wearspan.functions.times import epoch_micros
from wearspan.operators.contracts import (
    LABELED_TELEMETRY,
    RAW_TELEMETRY,
    SCORING_REQUEST,
    Contract,
    Field,
    check,
    custom,
    request_reason,
    request_shape,
    training_batch,
    windowed_features,
)
from wearspan.operators.windows import stamped_windows
from wearspan.queries.catalog import query
from wearspan.queries.series import AS_OF, windows_of_30
from wearspan.schemas import CYCLE, ENTITY, LABEL
from wearspan.sources import derived
from wearspan.sources.bindings import labeled, table, telemetry

_DAMAGED = """(SELECT CASE WHEN l_orderkey % 101 = 0 THEN 0 ELSE unit_number END AS unit_number, time_in_cycles,
    CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE sensor_1 END AS sensor_1,
    CASE WHEN l_orderkey % 89 = 0 THEN 1e7 ELSE sensor_2 END AS sensor_2,
    CASE WHEN l_orderkey % 79 = 0 THEN CAST('NaN' AS DOUBLE) ELSE sensor_3 END AS sensor_3,
    CASE WHEN l_orderkey % 73 = 0 THEN CAST('-Infinity' AS DOUBLE) ELSE sensor_4 END AS sensor_4,
    CASE WHEN l_orderkey % 83 = 0 THEN 9 ELSE failure_type END AS failure_type,
    CASE WHEN l_orderkey % 71 = 0 THEN -RUL - 1 ELSE RUL END AS RUL, dataset_id, global_unit, l_orderkey FROM lab)"""


def damaged(spark, sf_dir):
    """Labeled telemetry with nulls, NaN, infinities, out-of-range values and bad classes."""
    key = F.col("l_orderkey")
    return labeled(spark, sf_dir, ("l_orderkey",)).withColumns(
        {
            "unit_number": F.when(key % 101 == 0, 0).otherwise(F.col("unit_number")).cast("long"),
            "sensor_1": F.when(key % 97 != 0, F.col("sensor_1")),
            "sensor_2": F.when(key % 89 == 0, 1e7).otherwise(F.col("sensor_2")),
            "sensor_3": F.when(key % 79 == 0, float("nan")).otherwise(F.col("sensor_3")),
            "sensor_4": F.when(key % 73 == 0, float("-inf")).otherwise(F.col("sensor_4")),
            LABEL: F.when(key % 83 == 0, 9).otherwise(F.col(LABEL)),
            "RUL": F.when(key % 71 == 0, -F.col("RUL") - 1).otherwise(F.col("RUL")),
        }
    )


_RAW_FAILURES = f"""SELECT "check", n AS rows FROM (
  SELECT 'unit_number:greater_than_0' AS "check", count(*) FILTER (WHERE l_orderkey % 101 = 0) AS n FROM lab
  UNION ALL SELECT 'sensor_1:not_null', count(*) FILTER (WHERE sensor_1 IS NULL) FROM {_DAMAGED}
  UNION ALL SELECT 'sensor_2:magnitude', count(*) FILTER (WHERE abs(sensor_2) >= 1e6) FROM {_DAMAGED}
  UNION ALL SELECT 'sensor_3:not_null', count(*) FILTER (WHERE isnan(sensor_3)) FROM {_DAMAGED}
  UNION ALL SELECT 'sensor_4:magnitude', count(*) FILTER (WHERE isinf(sensor_4)) FROM {_DAMAGED}
  LABELED) WHERE n > 0"""


@query("ctr_1_raw_contract", _RAW_FAILURES.replace("LABELED", ""), ("lab",))
def raw_contract(spark, sf_dir):
    return check(damaged(spark, sf_dir), RAW_TELEMETRY).failure_counts()


@query(
    "ctr_2_labeled_contract",
    _RAW_FAILURES.replace(
        "LABELED",
        f"""UNION ALL SELECT 'failure_type:one_of_0_1_2', count(*) FILTER (WHERE failure_type NOT IN (0, 1, 2)) FROM {_DAMAGED}
  UNION ALL SELECT 'RUL:at_least_0', count(*) FILTER (WHERE RUL < 0) FROM {_DAMAGED}""",
    ),
    ("lab",),
)
def labeled_contract(spark, sf_dir):
    return check(damaged(spark, sf_dir), LABELED_TELEMETRY).failure_counts()


@query(
    "ctr_2_quarantine",
    f"""SELECT dataset_id, count(*) FILTER (WHERE bad) AS quarantined, count(*) FILTER (WHERE NOT bad) AS accepted FROM (
  SELECT dataset_id, (unit_number <= 0 OR sensor_1 IS NULL OR abs(sensor_2) >= 1e6 OR isnan(sensor_3) OR isinf(sensor_4)
         OR failure_type NOT IN (0, 1, 2) OR RUL < 0) AS bad FROM {_DAMAGED}) GROUP BY dataset_id""",
    ("lab",),
)
def quarantine(spark, sf_dir):
    """Good and bad rows as two tables, counted."""
    checked = check(damaged(spark, sf_dir), LABELED_TELEMETRY)
    bad = checked.bad().select("dataset_id", F.lit(1).alias("bad"))
    good = checked.good().select("dataset_id", F.lit(0).alias("bad"))
    return bad.unionByName(good).groupBy("dataset_id").agg(
        F.count_if(F.col("bad") == 1).alias("quarantined"),
        F.count_if(F.col("bad") == 0).alias("accepted"),
    )


@query(
    "ctr_7_failure_cases",
    f"""SELECT global_unit, time_in_cycles, 'sensor_1:not_null' AS "check" FROM {_DAMAGED} WHERE sensor_1 IS NULL
UNION ALL SELECT global_unit, time_in_cycles, 'sensor_3:not_null' FROM {_DAMAGED} WHERE isnan(sensor_3)""",
    ("lab",),
)
def missing_cases(spark, sf_dir):
    """One row per missing reading; NaN counts as missing."""
    contract = Contract("present", (Field("sensor_1"), Field("sensor_3")))
    return check(damaged(spark, sf_dir), contract).failure_cases().select(ENTITY, CYCLE, "check")


@query(
    "fn_6_magnitude",
    f"""SELECT dataset_id, count(*) FILTER (WHERE abs(sensor_2) < 1e6) AS in_range,
       count(*) FILTER (WHERE sensor_4 IS NOT NULL AND NOT isnan(sensor_4) AND NOT isinf(sensor_4)) AS finite_4,
       count(*) FILTER (WHERE sensor_3 IS NOT NULL AND NOT isnan(sensor_3) AND NOT isinf(sensor_3)) AS finite_3
FROM {_DAMAGED} GROUP BY dataset_id""",
    ("lab",),
)
def magnitude(spark, sf_dir):
    return damaged(spark, sf_dir).groupBy("dataset_id").agg(
        F.count_if(F.abs("sensor_2") < 1e6).alias("in_range"),
        F.count_if(is_finite(F.col("sensor_4"))).alias("finite_4"),
        F.count_if(is_finite(F.col("sensor_3"))).alias("finite_3"),
    )


@query(
    "ctr_6_coercion",
    """SELECT "check", n AS rows FROM (
  SELECT 'unit_number:coerce' AS "check", count(*) FILTER (WHERE l_orderkey % 61 = 0) AS n FROM tel
  UNION ALL SELECT 'time_in_cycles:coerce', count(*) FILTER (WHERE l_orderkey % 59 = 0) FROM tel
  UNION ALL SELECT 'sensor_2:coerce', count(*) FILTER (WHERE l_orderkey % 53 = 0) FROM tel) WHERE n > 0""",
    ("tel",),
)
def coercion(spark, sf_dir):
    """Text and fractional values: an integer sensor becomes a double, a word does not."""
    key = F.col("l_orderkey")
    rows = telemetry(spark, sf_dir, ("l_orderkey",)).withColumns(
        {
            "unit_number": F.when(key % 61 == 0, "unit").otherwise(F.col("unit_number").cast("string")),
            CYCLE: F.when(key % 59 == 0, F.col(CYCLE) + 0.5).otherwise(F.col(CYCLE).cast("double")),
            "sensor_1": F.col("sensor_1").cast("int"),
            "sensor_2": F.when(key % 53 == 0, "n/a").otherwise(F.col("sensor_2").cast("string")),
        }
    )
    return check(rows, RAW_TELEMETRY).failure_counts()


@query(
    "ctr_9_custom_predicate",
    """SELECT "check", n AS rows FROM (
  SELECT 'l_discount:below_tax' AS "check", count(*) FILTER (WHERE NOT (l_discount < l_tax + 0.05)) AS n FROM lineitem
  UNION ALL SELECT 'l_quantity:even', count(*) FILTER (WHERE l_quantity % 2 <> 0) FROM lineitem) WHERE n > 0""",
)
def custom_predicate(spark, sf_dir):
    contract = Contract(
        "line_rules",
        (
            Field("l_discount", checks=(custom("below_tax", lambda c: c < F.col("l_tax") + 0.05),)),
            Field("l_quantity", checks=(custom("even", lambda c: c % 2 == 0),)),
        ),
    )
    return check(table(spark, sf_dir, "lineitem"), contract).failure_counts()


def _damaged_windows(spark, sf_dir):
    """Window table rows, some with a short array, a blank engine or an unknown class."""
    end = F.col("end_cycle")
    windows = windows_of_30(spark, sf_dir).withColumn("global_index", end)
    stamped = stamped_windows(windows, AS_OF)
    seconds = F.expr("(_micros - _created) div 1000000 + 82800")
    stamped = (
        stamped.withColumn("_micros", epoch_micros("event_timestamp"))
        .withColumn("_created", epoch_micros("created_timestamp"))
        .withColumn("_cycle", (seconds / 10).cast("long"))
    )
    cycle = F.col("_cycle")
    return stamped.withColumns(
        {
            "windowed_features": F.when(
                cycle % 37 == 0, F.slice("windowed_features", 1, 119)
            ).otherwise(F.col("windowed_features")),
            "engine_id": F.when(cycle % 41 == 0, "").otherwise(F.col("engine_id")),
            LABEL: F.when(cycle % 43 == 0, 7).otherwise(F.col(LABEL)),
        }
    ).drop("_micros", "_created", "_cycle")


_WINDOW_FAILURES = """SELECT "check", n AS rows FROM (
  SELECT 'windowed_features:length' AS "check", count(*) FILTER (WHERE end_cycle % 37 = 0) AS n FROM win
  UNION ALL SELECT 'engine_id:length', count(*) FILTER (WHERE end_cycle % 41 = 0) FROM win
  UNION ALL SELECT 'failure_type:one_of_0_1_2', count(*) FILTER (WHERE end_cycle % 43 = 0) FROM win) WHERE n > 0"""


@query("ctr_3_windowed_contract", _WINDOW_FAILURES, ("win",))
def windowed_contract(spark, sf_dir):
    return check(_damaged_windows(spark, sf_dir), windowed_features(120)).failure_counts()


@query("ctr_4_training_contract", _WINDOW_FAILURES, ("win",))
def training_contract(spark, sf_dir):
    """Looser: a zoned timestamp is fine and the creation time may be absent."""
    rows = _damaged_windows(spark, sf_dir).drop("created_timestamp")
    rows = rows.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    return check(rows, training_batch(120)).failure_counts()


@query(
    "agg_17_length_violations",
    "SELECT engine_id, count(*) FILTER (WHERE end_cycle % 37 = 0) AS wrong_length, count(*) AS windows FROM win WHERE end_cycle % 41 <> 0 GROUP BY engine_id",
    ("win",),
)
def length_violations(spark, sf_dir):
    rows = _damaged_windows(spark, sf_dir).filter(F.col("engine_id") != "")
    return rows.groupBy("engine_id").agg(
        F.count_if(F.size("windowed_features") != 120).alias("wrong_length"),
        F.count(F.lit(1)).alias("windows"),
    )


@query(
    "ctr_10_request_contract",
    """SELECT vec_id, CASE WHEN length(engine_id) > 64 THEN 'engine_id length' WHEN trim(engine_id) = '' THEN 'engine_id blank'
       WHEN len(readings) = 0 THEN 'readings missing'
       WHEN vec_id % 7 = 0 THEN 'readings not rectangular at row 3'
       WHEN vec_id % 11 = 0 THEN 'readings not finite at row 5' END AS reason FROM requests""",
    ("requests",),
)
def request_contract(spark, sf_dir):
    return derived.requests(spark, sf_dir).select("vec_id", request_reason().alias("reason"))


@query(
    "ctr_11_shape_contract",
    """SELECT "check", n AS rows FROM (
  SELECT 'engine_id:length' AS "check", count(*) FILTER (WHERE length(engine_id) > 64) AS n FROM requests
  UNION ALL SELECT 'engine_id:not_blank', count(*) FILTER (WHERE trim(engine_id) = '') FROM requests
  UNION ALL SELECT 'readings:rectangular', count(*) FILTER (WHERE vec_id % 23 = 0 OR vec_id % 7 = 0) FROM requests
  UNION ALL SELECT 'readings:finite', count(*) FILTER (WHERE vec_id % 11 = 0 AND vec_id % 23 <> 0) FROM requests
  UNION ALL SELECT 'readings:shape', count(*) FILTER (WHERE vec_id % 23 = 0 OR vec_id % 7 = 0) FROM requests) WHERE n > 0""",
    ("requests",),
)
def shape_contract(spark, sf_dir):
    contract = SCORING_REQUEST.with_row_check(*request_shape(8, 8))
    return check(derived.requests(spark, sf_dir), contract).failure_counts()
