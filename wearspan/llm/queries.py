"""Registered queries of the subpackage: one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wearspan.llm import filters, imatch, minhash, oracles, packing, pages, personal, pieces, rans, secrets, sharding, structure, toxicity, vectors
from wearspan.llm.frames import table
from wearspan.session import scratch_path

VOCABULARY_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces_by_zipf = pieces.read_table(vocabulary_path(PIECE_FILE), zipf=True)
    return pieces.tokens_and_round_trip(table(spark, sf_dir, "documents"), pieces_by_zipf)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_components(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_texts(table(spark, sf_dir, "pages"))


def op6_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


def op7_p_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.personal_report(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = packing.read_vocabulary(vocabulary_path(VOCABULARY_FILE))
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary)


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.repair_report(table(spark, sf_dir, "conversations"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_rans_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    rans.write_tokens(table(spark, sf_dir, "documents"), path, packing.read_vocabulary(vocabulary_path(VOCABULARY_FILE)))
    return rans.read_documents(spark, path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_toxicity": op2_toxicity,
    "op3_kd_sharding": op3_kd_sharding,
    "op4_minhash": op4_minhash,
    "op5_html_extraction": op5_html_extraction,
    "op6_imatch": op6_imatch,
    "op7_p_stable": op7_p_stable,
    "op8_bootstrapped_pii": op8_bootstrapped_pii,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_secret_scans": op10_secret_scans,
    "op11_structure_repair": op11_structure_repair,
    "op12_filter_audit": op12_filter_audit,
    "op13_rans_output": op13_rans_output,
}

ORACLES: dict[str, str] = {
    "op4_minhash": oracles.NEAR_DOCUMENTS,
    "op7_p_stable": oracles.NEAR_VECTORS,
    "op12_filter_audit": oracles.FILTER_AUDIT,
}
