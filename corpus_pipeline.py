"""A training-corpus pipeline of four stages, each a Spark job on what the stage before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next one's docs. All but the last return the columns of docs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.llm import minhash, packing, secrets, toxicity
from wearspan.llm.frames import saved, table
from wearspan.llm.queries import VOCABULARY_FILE, vocabulary_path

# General near-duplicate setting: five words and a similarity of 0.8 or more.
NEAR = minhash.NearParams(percent=80)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score is below 0.5, all labels taught. Without labels of both kinds every row stays;
    NULL and empty texts stay."""
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(toxicity.labelled_texts(docs, labels))
    scored = toxicity.score(docs, model)
    clean = F.col(scored.columns[-1]) < 0.5
    return scored.where(clean | F.coalesce(F.trim("text") == "", F.lit(True))).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates the document with the smallest doc_id. Rows without doc_id or without words stay.

    A document is a (doc_id, text): rows that share a doc_id but not their text are judged apart, the smaller SHA-256
    of the text first, and of rows that share both one stays.
    """
    named = docs.where("doc_id IS NOT NULL")
    if not named.groupBy("doc_id").count().where("count > 1").limit(1).count():
        leave = saved(near_duplicates(docs.select("doc_id", "text")), "leave")
        return docs.join(leave, "doc_id", "left_anti").select(*docs.columns)
    digest = F.coalesce(F.sha2(F.col("text").cast("string"), 256), F.lit("none"))
    marked = named.select(F.struct(*docs.columns).alias("row"), "doc_id", digest.alias("digest"))
    one = saved(marked.groupBy("doc_id", "digest").agg(F.first("row").alias("row")), "versions")
    # Numbers in the order of (doc_id, digest), which spreads a hot doc_id over ranges; written, so that they stay.
    ranged = one.repartitionByRange("doc_id", "digest").sortWithinPartitions("doc_id", "digest")
    numbered = saved(ranged.withColumn("number", F.monotonically_increasing_id()), "numbered")
    leave = saved(near_duplicates(numbered.select(F.col("number").alias("doc_id"), F.col("row.text").alias("text"))), "leave")
    kept = numbered.join(leave.withColumnRenamed("doc_id", "number"), "number", "left_anti").select("row.*")
    return kept.unionByName(docs.where("doc_id IS NULL"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """The ids of `docs` that leave."""
    return minhash.near_components(docs, NEAR).where("NOT kept").select("doc_id")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, with the secrets in its text replaced."""
    return secrets.mask_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of every row, placed in sequences of at most 1024 tokens."""
    return packing.pack_documents(docs, packing.read_vocabulary(vocabulary_path(VOCABULARY_FILE)))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", one_of_each_group),
    ("secret_scans", mask_secrets),
    ("packing", pack),
]

# The trained classifier and the tokenizer have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
