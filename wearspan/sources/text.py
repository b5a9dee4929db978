"""Headerless whitespace-delimited telemetry text."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.operators.labeling import entity_key
from wearspan.schemas import ENTITY, LINE_COLUMNS, SUB_DATASETS

FILE_GLOB = "train_{" + ",".join(SUB_DATASETS) + "}.txt"
TOKENS = "_tokens"
# What a regular expression takes as white space; a line is trimmed of it without one.
BLANKS = " \t\n\x0b\f\r"


def tokens(line: Column) -> Column:
    return F.split(F.btrim(line, F.lit(BLANKS)), r"\s+")


def read_lines(spark: SparkSession, data_dir: str) -> DataFrame:
    """Non-blank lines of every sub-dataset present, tagged with `dataset_id`.

    One scan over a glob: absent sub-datasets are skipped, and no file at all is an error.
    """
    try:
        lines = spark.read.text(f"{data_dir}/{FILE_GLOB}")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        raise FileNotFoundError(f"no telemetry file {FILE_GLOB} in {data_dir}") from error
    dataset = F.regexp_extract("_metadata.file_path", r"train_(FD\d{3})\.txt", 1)
    return lines.select("value", dataset.alias("dataset_id")).filter(
        F.col("value").rlike(r"\S")
    )


def parse_lines(lines: DataFrame) -> DataFrame:
    """Lines to telemetry columns. A token that is no number becomes NULL; `token_count` is kept so
    that a line of another width fails the contract instead of shifting its values."""
    split = lines.withColumn(TOKENS, tokens(F.col("value")))
    columns = [
        F.get(TOKENS, F.lit(i)).try_cast("bigint" if i < 2 else "double").alias(name)
        for i, name in enumerate(LINE_COLUMNS)
    ]
    return split.select(*columns, "dataset_id", F.size(TOKENS).alias("token_count")).withColumn(
        ENTITY, entity_key(F.col("dataset_id"), F.col("unit_number"))
    )


def read_telemetry(spark: SparkSession, data_dir: str) -> DataFrame:
    return parse_lines(read_lines(spark, data_dir))


def write_lines(rows: DataFrame, path: str) -> None:
    """Write telemetry columns as text lines, values separated by one space."""
    text = F.concat_ws(" ", *[F.col(c).cast("string") for c in LINE_COLUMNS])
    rows.select(text.alias("value")).write.mode("errorifexists").text(path)


def pick_units(lines: DataFrame, units: set[int], dataset: str = "FD001") -> DataFrame:
    """Lines of the given units of one sub-dataset, byte for byte."""
    first = F.get(tokens(F.col("value")), F.lit(0)).try_cast("int")
    return lines.filter((F.col("dataset_id") == dataset) & first.isin(*sorted(units))).select("value")


def extract_units(
    spark: SparkSession, data_dir: str, target: str, units: set[int], dataset: str = "FD001"
) -> None:
    """Write a small fixed subset of the raw lines; keeping nothing is an error."""
    picked = pick_units(read_lines(spark, data_dir), units, dataset)
    if picked.isEmpty():
        raise RuntimeError(f"no line of {dataset} belongs to units {sorted(units)}")
    picked.write.mode("overwrite").text(f"{target}/train_{dataset}.txt")
