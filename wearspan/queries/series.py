"""Window operators over engine series."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from wearspan.functions.times import epoch_micros
from wearspan.operators.labeling import clean_telemetry, drop_duplicate_rows, drop_flat
from wearspan.operators.ordinals import series_bounds, series_ordinal
from wearspan.operators.windows import (
    indexed_windows,
    sliding_windows,
    stamped_windows,
    window_counts,
    written_rows,
)
from wearspan.queries.catalog import VARYING, query
from wearspan.schemas import CYCLE, ENTITY, LABEL
from wearspan.sources.bindings import (
    event_feed,
    labeled,
    labeled_series,
    telemetry,
    with_copies,
)

AS_OF = datetime(2024, 6, 1)


def windows_of_30(spark, sf_dir):
    rows, plan = labeled_series(spark, sf_dir)
    return sliding_windows(rows, 30, VARYING, plan=plan)


def indexed_clean(spark, sf_dir):
    rows = drop_duplicate_rows(with_copies(labeled(spark, sf_dir, ("l_orderkey",))))
    return indexed_windows(drop_flat(written_rows(rows)), 30)


def entry(spark, sf_dir):
    """Windows and critical share per sub-dataset and class."""
    windows = windows_of_30(spark, sf_dir)
    return (
        windows.groupBy(F.substring("engine_id", 1, 5).alias("dataset_id"), LABEL)
        .agg(
            F.count(F.lit(1)).alias("windows"),
            F.countDistinct("engine_id").alias("engines"),
            F.min("end_cycle").alias("first_end"),
            F.max("end_cycle").alias("last_end"),
        )
        .orderBy("dataset_id", LABEL)
    )


@query(
    "win_1_sliding_windows",
    """SELECT engine_id, end_cycle, failure_type, CAST(len(readings) AS BIGINT) AS steps,
       CAST(round(CAST(readings[1][2] AS DOUBLE) * 100) AS BIGINT) AS oldest,
       CAST(round(CAST(readings[30][2] AS DOUBLE) * 100) AS BIGINT) AS newest,
       CAST(list_sum(list_transform(readings, lambda r: CAST(round(CAST(r[1] AS DOUBLE)) AS BIGINT))) AS BIGINT) AS total
FROM win""",
    ("win",),
)
def sliding(spark, sf_dir):
    first_step = F.element_at("readings", 1)
    last_step = F.element_at("readings", -1)
    total = F.aggregate(
        "readings",
        F.lit(0).cast("long"),
        lambda acc, r: acc + F.round(F.element_at(r, 1).cast("double")).cast("long"),
    )
    return windows_of_30(spark, sf_dir).select(
        "engine_id",
        "end_cycle",
        LABEL,
        F.size("readings").cast("long").alias("steps"),
        F.round(F.element_at(first_step, 2).cast("double") * 100).cast("long").alias("oldest"),
        F.round(F.element_at(last_step, 2).cast("double") * 100).cast("long").alias("newest"),
        total.alias("total"),
    )


@query(
    "win_2_window_labels",
    """SELECT dataset_id, failure_type, count(*) AS windows, count(DISTINCT engine_id) AS engines,
       min(end_cycle) AS first_end, max(end_cycle) AS last_end FROM win GROUP BY dataset_id, failure_type""",
    ("win",),
)
def window_labels(spark, sf_dir):
    return entry(spark, sf_dir)


@query(
    "win_3_series_bounds",
    """SELECT global_unit, CAST(sum(n) OVER (ORDER BY global_unit) - n + 1 AS BIGINT) AS start_position,
       CAST(sum(n) OVER (ORDER BY global_unit) AS BIGINT) AS end_position
FROM (SELECT global_unit, count(*) AS n FROM tel GROUP BY global_unit)""",
    ("tel",),
)
def bounds(spark, sf_dir):
    return series_bounds(telemetry(spark, sf_dir), ENTITY, [CYCLE])


@query(
    "win_4_dense_window_index",
    """SELECT global_unit AS engine_id, time_in_cycles AS end_cycle, position - 30 AS window_index,
       CAST(row_number() OVER (ORDER BY global_unit, position) - 1 AS BIGINT) AS global_index
FROM numbered WHERE position >= 30""",
    ("numbered",),
)
def dense_index(spark, sf_dir):
    return indexed_clean(spark, sf_dir).select(
        "engine_id", "end_cycle", "window_index", "global_index"
    )


@query(
    "fn_5_event_times",
    """SELECT engine_id, min(us) AS first_event, max(us) AS last_event, count(*) AS windows
FROM (SELECT global_unit AS engine_id,
             epoch_us(TIMESTAMP '2024-05-31 01:00:00') + 10000000 * (row_number() OVER (ORDER BY global_unit, position) - 1) AS us
      FROM numbered WHERE position >= 30)
GROUP BY engine_id""",
    ("numbered",),
)
def event_times(spark, sf_dir):
    stamped = stamped_windows(indexed_clean(spark, sf_dir), AS_OF)
    micros = epoch_micros("event_timestamp")
    return stamped.groupBy("engine_id").agg(
        F.min(micros).alias("first_event"),
        F.max(micros).alias("last_event"),
        F.count(F.lit(1)).alias("windows"),
    )


@query(
    "srt_1_series_order",
    """SELECT global_unit, time_in_cycles,
       row_number() OVER (PARTITION BY global_unit ORDER BY time_in_cycles, sensor_1, sensor_2) AS position FROM feed""",
    ("feed",),
)
def series_order(spark, sf_dir):
    feed = event_feed(spark, sf_dir)
    return series_ordinal(feed, ENTITY, [CYCLE, "sensor_1", "sensor_2"], "position").select(
        ENTITY, CYCLE, "position"
    )


@query(
    "agg_15_window_counts",
    "SELECT global_unit, count(*) AS rows, greatest(0, count(*) - 30 + 1) AS windows FROM clean GROUP BY global_unit",
    ("clean",),
)
def counts(spark, sf_dir):
    clean = clean_telemetry(with_copies(labeled(spark, sf_dir, ("l_orderkey",))))
    return window_counts(clean, 30)


@query(
    "fil_3_short_series",
    """SELECT global_unit AS engine_id, count(*) AS windows, CAST(sum(total) AS BIGINT) AS total FROM (
  SELECT global_unit, count(*) OVER w AS n, sum(CAST(round(sensor_2) AS BIGINT)) OVER w AS total FROM feed
  WINDOW w AS (PARTITION BY global_unit ORDER BY time_in_cycles, sensor_1, sensor_2 ROWS BETWEEN 69 PRECEDING AND CURRENT ROW))
WHERE n = 70 GROUP BY global_unit""",
    ("feed",),
)
def short_series(spark, sf_dir):
    """Users with fewer than 70 events give no window."""
    feed = event_feed(spark, sf_dir).withColumn(LABEL, F.lit(0))
    windows = sliding_windows(feed, 70, ["sensor_1", "sensor_2"])
    total = F.aggregate(
        "readings",
        F.lit(0).cast("long"),
        lambda acc, r: acc + F.round(F.element_at(r, 2).cast("double")).cast("long"),
    )
    return windows.groupBy("engine_id").agg(
        F.count(F.lit(1)).alias("windows"), F.sum(total).alias("total")
    )


@query(
    "fn_12_flattened_windows",
    """SELECT engine_id, count(*) AS windows, CAST(sum(len(flat)) AS BIGINT) AS floats,
       CAST(sum(CAST(round(CAST(flat[2] AS DOUBLE) * 100) AS BIGINT) + CAST(round(CAST(flat[118] AS DOUBLE) * 100) AS BIGINT)) AS BIGINT) AS ends
FROM (SELECT engine_id, flatten(readings) AS flat FROM win) GROUP BY engine_id""",
    ("win",),
)
def flattened(spark, sf_dir):
    flat = windows_of_30(spark, sf_dir).select(
        "engine_id", F.flatten("readings").alias("flat")
    )

    def cents(i):
        return F.round(F.element_at("flat", i).cast("double") * 100).cast("long")

    return flat.groupBy("engine_id").agg(
        F.count(F.lit(1)).alias("windows"),
        F.sum(F.size("flat")).alias("floats"),
        F.sum(cents(2) + cents(118)).alias("ends"),
    )
