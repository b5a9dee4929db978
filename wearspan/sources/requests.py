"""Scoring requests in and predictions out, as JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.schemas import CORRUPT_COLUMN, REQUEST, REQUEST_WITH_CORRUPT


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Requests of the declared shape, one in a line; anything else is kept whole in `_corrupt_record`."""
    return _requests(spark.read.text(path))


def stream_requests(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _requests(reader.text(path))


def _requests(lines: DataFrame) -> DataFrame:
    """Blank lines are no requests."""
    parsed = lines.where(F.trim("value") != "").select(parse_request(F.col("value")).alias("request"))
    return parsed.select("request.*")


def parse_request(text: Column) -> Column:
    """A JSON request held in a column; text of another shape keeps itself in `_corrupt_record`.

    Types are taken as they are written: an `engine_id` that is a number, a truth value, a list or an object is
    refused, never turned into text, and so is JSON that is not strict, that names a key twice, whose outermost
    value is no object or that is followed by anything. A missing or null `engine_id` stays NULL for the contract to find. NULL text gives NULL.
    """
    parsed = F.from_json(
        text,
        REQUEST_WITH_CORRUPT,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN},
    )
    # Whatever may follow a value cannot close both a list and an object.
    value = F.try_parse_json(F.concat(F.lit('{"request": '), text, F.lit("}")))
    alone = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).isNotNull()
    engine = F.schema_of_variant(F.variant_get(value, "$.request.engine_id", "variant"))
    typed = value.isNotNull() & alone & F.ltrim(text).startswith("{") & F.coalesce(engine.isin("STRING", "VOID"), F.lit(True))
    shaped = F.when(typed | parsed[CORRUPT_COLUMN].isNotNull(), parsed).otherwise(
        F.from_json(F.lit(None).cast("string"), REQUEST_WITH_CORRUPT)
    )
    corrupt = F.when(typed & parsed[CORRUPT_COLUMN].isNull(), F.lit(None).cast("string")).otherwise(text)
    return F.when(text.isNotNull(), F.struct(*[shaped[c].alias(c) for c in REQUEST.names], corrupt.alias(CORRUPT_COLUMN)))


def request_json(engine: Column, readings: Column) -> Column:
    return F.to_json(F.struct(engine.alias("engine_id"), readings.alias("readings")))


def write_predictions(answers: DataFrame, path: str, mode: str = "append") -> None:
    answers.write.mode(mode).json(path)


def append_audit(audit: DataFrame, path: str) -> None:
    audit.write.mode("append").parquet(path)


__all__ = [
    "REQUEST",
    "append_audit",
    "parse_request",
    "read_requests",
    "request_json",
    "stream_requests",
    "write_predictions",
]
