"""Requests and answers in batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from wearspan.functions.arrays import reshape
from wearspan.operators.scoring import (
    accepted_and_rejected,
    audit_rows,
    critical_above,
    responses,
)
from wearspan.queries.catalog import query
from wearspan.schemas import CORRUPT_COLUMN
from wearspan.session import scratch_path
from wearspan.sources import derived
from wearspan.sources.bindings import table
from wearspan.sources.requests import (
    append_audit,
    read_requests,
    request_json,
    write_predictions,
)

VERSION = "7"
ANSWER_SCHEMA = (
    "engine_id string, prediction string, "
    "probabilities struct<Healthy: double, Alert: double, Critical: double>, model_version string"
)


def answers(spark, sf_dir):
    return responses(derived.scored(spark, sf_dir), VERSION)


@query(
    "src_10_predictions",
    """SELECT engine_id, prediction, round(p_healthy, 6) AS p_healthy, round(p_alert, 6) AS p_alert,
       round(p_critical, 6) AS p_critical, '7' AS model_version FROM answers""",
    ("answers",),
)
def predictions(spark, sf_dir):
    """Answers written as JSON lines and read back (PRJ-9, FN-17)."""
    path = scratch_path(spark, "answers")
    write_predictions(answers(spark, sf_dir), path)
    rows = spark.read.schema(ANSWER_SCHEMA).json(path)
    return rows.select(
        "engine_id",
        "prediction",
        *[F.col(f"probabilities.{n}").alias(f"p_{n.lower()}") for n in ("Healthy", "Alert", "Critical")],
        "model_version",
    )


@query(
    "src_12_audit",
    "SELECT engine_id, prediction, '7' AS model_version, count(*) AS served FROM answers GROUP BY ALL",
    ("answers",),
)
def audit(spark, sf_dir):
    path = scratch_path(spark, "audit")
    append_audit(audit_rows(answers(spark, sf_dir)), path)
    rows = spark.read.schema("engine_id string, prediction string, model_version string").parquet(path)
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("served"))


@query(
    "scr_7_critical_threshold",
    """SELECT engine_id, round(p_critical, 6) AS p_critical, prediction FROM answers WHERE round(p_critical, 6) > 0.3""",
    ("answers",),
)
def critical(spark, sf_dir):
    rows = critical_above(answers(spark, sf_dir), 0.3)
    return rows.select(
        "engine_id", F.col("probabilities")["Critical"].alias("p_critical"), "prediction"
    )


@query(
    "scr_5_refused_requests",
    """SELECT reasons, count(*) AS requests FROM (
  SELECT array_to_string(list_filter([CASE WHEN length(engine_id) > 64 THEN 'engine_id:length' END, CASE WHEN trim(engine_id) = '' THEN 'engine_id:not_blank' END,
      CASE WHEN vec_id % 23 = 0 OR vec_id % 7 = 0 THEN 'readings:rectangular' END,
      CASE WHEN vec_id % 11 = 0 AND vec_id % 23 <> 0 THEN 'readings:finite' END,
      CASE WHEN vec_id % 23 = 0 OR vec_id % 7 = 0 THEN 'readings:shape' END], lambda x: x IS NOT NULL), ',') AS reasons FROM requests)
GROUP BY reasons""",
    ("requests",),
)
def refused(spark, sf_dir):
    """Accepted and refused requests, with every reason."""
    good, bad = accepted_and_rejected(derived.requests(spark, sf_dir), 8, 8)
    rows = good.select(F.lit("").alias("reasons")).unionByName(bad.select("reasons"))
    return rows.groupBy("reasons").agg(F.count(F.lit(1)).alias("requests"))


@query(
    "src_9_request_files",
    """SELECT CASE WHEN vec_id % 13 = 0 OR vec_id % 7 = 0 THEN 'malformed' ELSE 'parsed' END AS status, count(*) AS requests,
       CAST(sum(CASE WHEN vec_id % 13 = 0 OR vec_id % 7 = 0 THEN 0 ELSE 8 END) AS BIGINT) AS steps FROM embeddings GROUP BY ALL""",
)
def request_files(spark, sf_dir):
    """JSON files with cut-off lines and text where numbers belong; nothing is coerced away."""
    rows = table(spark, sf_dir, "embeddings")
    text = request_json(
        F.col("label").cast("string"), reshape(F.col("embedding").cast("array<double>"), 8, 8)
    )
    damaged = (
        F.when(F.col("vec_id") % 13 == 0, F.substring(text, 1, 40))
        .when(F.col("vec_id") % 7 == 0, F.lit('{"engine_id": "x", "readings": "none"}'))
        .otherwise(text)
    )
    path = scratch_path(spark, "requests")
    rows.select(damaged.alias("value")).write.text(path)
    read = read_requests(spark, path)
    status = F.when(F.col(CORRUPT_COLUMN).isNotNull(), "malformed").otherwise("parsed")
    steps = F.when(F.col(CORRUPT_COLUMN).isNull(), F.size("readings")).otherwise(0)
    return read.select(status.alias("status"), steps.alias("_steps")).groupBy("status").agg(
        F.count(F.lit(1)).alias("requests"), F.sum("_steps").alias("steps")
    )


@query(
    "src_9_strict_types",
    """SELECT CASE WHEN vec_id % 6 = 0 THEN '{"engine_id": ' || vec_id || ', "readings": [[1.0]]}'
            WHEN vec_id % 6 = 1 THEN '{"engine_id": ' || (CASE WHEN vec_id % 4 = 1 THEN 'true' ELSE 'false' END) || ', "readings": [[1.0]]}'
            WHEN vec_id % 6 = 2 THEN '[{"engine_id": "' || vec_id || '", "readings": [[1.0]]}]'
            WHEN vec_id % 6 = 3 THEN '{"engine_id": {"id": "' || vec_id || '"}, "readings": [[1.0]]}' END AS refused,
       CASE WHEN vec_id % 6 = 4 THEN CAST(vec_id AS VARCHAR) END AS engine_id, count(*) AS requests FROM embeddings GROUP BY ALL""",
)
def strict_types(spark, sf_dir):
    """Engine ids that are numbers, truth values or objects, and lists of requests, come back with their text; null ids are no text."""
    vec = F.col("vec_id")
    head, tail = F.lit('{"engine_id": '), F.lit(', "readings": [[1.0]]}')
    kinds = {
        0: F.concat(head, vec.cast("string"), tail),
        1: F.concat(head, (vec % 4 == 1).cast("string"), tail),
        2: F.concat(F.lit('[{"engine_id": "'), vec.cast("string"), F.lit('", "readings": [[1.0]]}]')),
        3: F.concat(head, F.lit('{"id": "'), vec.cast("string"), F.lit('"}'), tail),
        4: F.concat(head, F.lit('"'), vec.cast("string"), F.lit('"'), tail),
    }
    text = F.concat(head, F.lit("null"), tail)
    for kind, form in kinds.items():
        text = F.when(vec % 6 == kind, form).otherwise(text)
    path = scratch_path(spark, "typed-requests")
    table(spark, sf_dir, "embeddings").select(text.alias("value")).write.text(path)
    return read_requests(spark, path).groupBy(F.col(CORRUPT_COLUMN).alias("refused"), "engine_id").agg(F.count(F.lit(1)).alias("requests"))
