"""The corpus pipeline: documents pass the stages one after another, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm import exact_dedup, jaccard, packing, secret_scan, toxicity
from fieldloom.llm.common import discard, documents, importable, stage, step

#: Near duplicates: shingles of five words, a similarity of 0.8 or more.
SHINGLE_WORDS, SIMILAR, OUT_OF = 5, 80, 100
#: The id of a row within a stage; ``docs`` may have a column of any other name.
ROW = "__row"


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a row id, as decisions are about rows: the doc_id where every row has one of its own.

    Where ids are null or repeat, rows are numbered and written out, so that a number stays with its row.
    """
    key = F.col("doc_id").cast("long")
    unsound = docs.groupBy(key.alias("doc_id")).agg(F.count("*").alias("n")).filter("doc_id IS NULL OR n > 1")
    if unsound.isEmpty():
        return docs.withColumn(ROW, key)
    return stage(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")


def _staying(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows whose row id is in ``kept``, without it."""
    return rows.join(kept.select(F.col(kept.columns[0]).alias(ROW)), ROW, "left_semi").drop(ROW)


def _one_of_each(rows: DataFrame, groups: DataFrame, group: str) -> DataFrame:
    """The row ids that stay: in each group the smallest doc_id, a null one last, then the first row."""
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", ROW)
    members = groups.select(F.col("doc_id").alias(ROW), F.col(group).alias("group")).join(rows.select(ROW, "doc_id"), ROW)
    return members.groupBy("group").agg(F.min(order).alias("first")).select(f"first.{ROW}")


def civil_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored 0.5 or more for toxicity go, each for its own text; texts without any sign of it stay."""
    importable(spark)
    rows = _numbered(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _staying(rows, toxicity.toxicity(rows, labels, ROW).filter("predicted = 0").select("row"))


def unique_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts one stays, that with the smallest doc_id."""
    rows = _numbered(docs)
    return _staying(rows, _one_of_each(rows, exact_dedup.exact_duplicates(rows, id_col=ROW), "keep_id"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by near-equal texts, directly or through others, one stays, that with the smallest doc_id."""
    rows = _numbered(docs)
    groups = jaccard.similar_texts(rows, SHINGLE_WORDS, SIMILAR, OUT_OF, id_col=ROW)
    return _staying(rows, _one_of_each(rows, groups, "component_id"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; each secret in its text gives way to a mark of its kind."""
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in token windows, with their ids."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", civil_documents),
    ("exact dedup", unique_documents),
    ("n-gram jaccard join", distinct_documents),
    ("secret scans", without_secrets),
    ("packing", packed),
]

#: Of the stages only exact dedup has a SQL form; tests/llm holds the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that come out of the last stage for the table ``documents``.

    What a stage wrote on its way, and its input, are removed once its result is written.
    """
    docs, last = documents(spark, sf_dir), None
    for name, apply in STAGES:
        with step(spark) as keep:
            docs = keep(stage(apply(spark, docs, sf_dir), name.replace(" ", "-")))
        if last is not None:
            discard(last)
        last = docs
    return docs
