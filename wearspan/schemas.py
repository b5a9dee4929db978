"""Fixed schemas and domain values."""

from __future__ import annotations

from pyspark.sql import types as T

# The class domain, its order and the remaining-life thresholds.
CLASS_NAMES = ("Healthy", "Alert", "Critical")
HEALTHY, ALERT, CRITICAL = 0, 1, 2
ALERT_AT_RUL = 60
CRITICAL_AT_RUL = 30

# The layout of a telemetry text line.
SUB_DATASETS = ("FD001", "FD002", "FD003", "FD004")
SETTING_COLUMNS = tuple(f"op_setting_{i}" for i in range(1, 4))
SENSOR_COLUMNS = tuple(f"sensor_{i}" for i in range(1, 22))
LINE_COLUMNS = ("unit_number", "time_in_cycles", *SETTING_COLUMNS, *SENSOR_COLUMNS)

# Names that results must leave out of the features, since they say which row it is or its answer.
IDENTIFIER_COLUMNS = ("unit_number", "time_in_cycles", "global_unit", "failure_type")

ENTITY = "global_unit"
CYCLE = "time_in_cycles"
LABEL = "failure_type"

RAW_TELEMETRY = T.StructType(
    [T.StructField(name, T.LongType(), False) for name in LINE_COLUMNS[:2]]
    + [T.StructField(name, T.DoubleType(), False) for name in LINE_COLUMNS[2:]]
    + [T.StructField(name, T.StringType(), False) for name in ("dataset_id", ENTITY)]
)

WINDOW_TABLE = T.StructType(
    [
        T.StructField("engine_id", T.StringType(), False),
        T.StructField("event_timestamp", T.TimestampNTZType(), False),
        T.StructField("created_timestamp", T.TimestampNTZType(), False),
        T.StructField("windowed_features", T.ArrayType(T.FloatType(), False), False),
        T.StructField(LABEL, T.IntegerType(), False),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("position", T.IntegerType(), False),
        T.StructField("feature", T.StringType(), False),
    ]
)

READINGS = T.ArrayType(T.ArrayType(T.DoubleType()))
REQUEST = T.StructType(
    [
        T.StructField("engine_id", T.StringType()),
        T.StructField("readings", READINGS),
    ]
)
CORRUPT_COLUMN = "_corrupt_record"
REQUEST_WITH_CORRUPT = T.StructType(
    [*REQUEST.fields, T.StructField(CORRUPT_COLUMN, T.StringType())]
)

RUN_VALUES = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("value", T.StringType()),
    ]
)
RUN_METRICS = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("step", T.IntegerType()),
        T.StructField("metric", T.StringType(), False),
        T.StructField("value", T.DoubleType()),
    ]
)
PROMOTIONS = T.StructType(
    [
        T.StructField("model_name", T.StringType(), False),
        T.StructField("version", T.LongType(), False),
        T.StructField("run_id", T.StringType()),
        T.StructField("promoted_at", T.TimestampNTZType(), False),
    ]
)
MODEL_SHAPES = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("window_size", T.IntegerType()),
        T.StructField("model_features", T.IntegerType()),
        T.StructField("scaler_features", T.IntegerType(), False),
    ]
)
DECISIONS = T.StructType(
    [
        T.StructField("model_name", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("run_id", T.StringType()),
    ]
)
LINEAR_MODEL = T.StructType(
    [
        T.StructField("class", T.IntegerType(), False),
        T.StructField("intercept", T.DoubleType(), False),
        T.StructField("weights", T.ArrayType(T.DoubleType(), False), False),
    ]
)
LINEAR_MODELS = T.StructType([T.StructField("run_id", T.StringType()), *LINEAR_MODEL.fields])
SCALERS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("feature", T.StringType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("std", T.DoubleType()),
        T.StructField("n", T.LongType()),
    ]
)
