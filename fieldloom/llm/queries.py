"""The queries of this package, (spark, directory of the tables) -> DataFrame, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldloom.llm import embeddings, exact_dedup, fill_middle, jaccard, licenses, main_text, packing, pieces, secret_scan, sharding, suffix_dedup, toxicity, vector_codes
from fieldloom.llm.common import documents


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_shard_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_texts(documents(spark, sf_dir))[0]


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(documents(spark, sf_dir)).drop("spans")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licence_digest(documents(spark, sf_dir))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(documents(spark, sf_dir))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trips(documents(spark, sf_dir))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir)).drop("ids", "width")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.fill_in_middle_digest(documents(spark, sf_dir))


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("op") and callable(f)}
ORACLES = {
    "op9_exact_dedup": exact_dedup.ORACLE,
    "op11_fill_in_middle": fill_middle.ORACLE,
    "op13_vector_codes": vector_codes.ORACLE,
}
