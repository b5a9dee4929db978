"""Text sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from wearspan.operators.contracts import check
from wearspan.plans.features import TEXT_TELEMETRY
from wearspan.queries.catalog import query
from wearspan.schemas import CYCLE, ENTITY, SUB_DATASETS
from wearspan.session import scratch_path, written
from wearspan.sources.bindings import telemetry
from wearspan.sources.text import (
    extract_units,
    parse_lines,
    pick_units,
    read_lines,
    read_telemetry,
    write_lines,
)


def text_files(spark, sf_dir) -> str:
    """Telemetry written as text, one path per sub-dataset; the other sensors repeat the first."""
    # Written by sub-dataset, so that each file's job reads its own part only; what repeats is made while lines are written.
    parts = written(telemetry(spark, sf_dir), "lines", "dataset_id")
    full = parts.withColumns({f"sensor_{i}": F.col("sensor_1") * i for i in range(6, 22)})
    folder = scratch_path(spark, "text")
    for dataset in SUB_DATASETS:
        write_lines(full.filter(F.col("dataset_id") == dataset), f"{folder}/train_{dataset}.txt")
    return folder


@query(
    "src_1_text_telemetry",
    """SELECT dataset_id, count(*) AS rows, count(DISTINCT global_unit) AS engines, CAST(sum(time_in_cycles) AS BIGINT) AS cycles,
       CAST(sum(CAST(round(sensor_2 * 100) AS BIGINT)) AS BIGINT) AS sensor_2, CAST(sum(CAST(round(sensor_1 * 21) AS BIGINT)) AS BIGINT) AS sensor_21
FROM tel GROUP BY dataset_id""",
    ("tel",),
)
def text_telemetry(spark, sf_dir):
    """Written as text lines, read back through one glob, tagged by file (SRC-2)."""
    rows = read_telemetry(spark, text_files(spark, sf_dir))
    return rows.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(ENTITY).alias("engines"),
        F.sum(CYCLE).alias("cycles"),
        F.sum(F.round(F.col("sensor_2") * 100).cast("long")).alias("sensor_2"),
        F.sum(F.round("sensor_21").cast("long")).alias("sensor_21"),
    )


@query(
    "src_7_unit_lines",
    """SELECT unit_number, count(*) AS lines, CAST(sum(time_in_cycles) AS BIGINT) AS cycles FROM tel
WHERE dataset_id = 'FD001' AND unit_number IN (1, 2, 3, 4, 5) GROUP BY unit_number""",
    ("tel",),
)
def unit_lines(spark, sf_dir):
    """Lines of units 1 to 5 copied as they are, then read back (FIL-2, FN-2)."""
    target = scratch_path(spark, "units")
    extract_units(spark, text_files(spark, sf_dir), target, {1, 2, 3, 4, 5})
    return read_telemetry(spark, target).groupBy("unit_number").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(CYCLE).alias("cycles")
    )


@query(
    "ctr_1_text_contract",
    """SELECT "check", n AS rows FROM (
  SELECT 'line:token_count' AS "check", count(*) FILTER (WHERE time_in_cycles % 31 = 0) AS n FROM tel
  UNION ALL SELECT 'sensor_21:not_null', count(*) FILTER (WHERE time_in_cycles % 31 = 0 OR time_in_cycles % 29 = 0) FROM tel) WHERE n > 0""",
    ("tel",),
)
def text_contract(spark, sf_dir):
    """Cut-off lines and words among numbers are reported, never shifted into other columns."""
    folder = text_files(spark, sf_dir)
    cycle = F.split("value", " ")[1].cast("int")
    without_last = F.regexp_replace("value", r" [^ ]+$", "")
    lines = read_lines(spark, folder).withColumn(
        "value",
        F.when(cycle % 31 == 0, without_last)
        .when(cycle % 29 == 0, F.concat(without_last, F.lit(" bad")))
        .otherwise(F.concat(F.lit("  "), F.col("value"), F.lit("   "))),
    )
    return check(parse_lines(lines), TEXT_TELEMETRY).failure_counts()


@query(
    "fn_2_first_token",
    "SELECT unit_number, count(*) AS lines FROM tel WHERE dataset_id = 'FD002' AND unit_number IN (2, 6, 10) GROUP BY unit_number",
    ("tel",),
)
def first_token(spark, sf_dir):
    picked = pick_units(read_lines(spark, text_files(spark, sf_dir)), {2, 6, 10}, "FD002")
    return picked.groupBy(
        F.split("value", " ")[0].cast("long").alias("unit_number")
    ).agg(F.count(F.lit(1)).alias("lines"))
