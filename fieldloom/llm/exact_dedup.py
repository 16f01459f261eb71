"""Exact duplicates by skew-safe combining, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import stage

SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16, digest=sha256) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row for each row of ``docs``.

    Texts are equal when they are identical after each run of white space has become
    one space; null counts as empty.  Of equal texts the smallest doc_id stays; a null
    doc_id never stays beside another one.  Rows that repeat a doc_id with an equal
    text count in ``group_size`` and carry the same decision.  An empty table gives an
    empty result.  Other columns of ``docs`` are not read.

    Copies are combined three times, by digest *and* whole text each time: in the
    task that reads them (the partial aggregate), per salt, and over the salts.  So a
    group of copies of any size reaches a task as one row per task and salt.  Decisions
    go back by digest alone only where that combining has found one text behind the
    digest; the texts of any other digest are compared whole once more.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), normalised(F.col(f"`{text_col}`")).alias("body"))
    rows = rows.select("doc_id", "body", digest(F.col("body")).alias("digest"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
    salt_winners = salted.groupBy("digest", "salt", "body").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    winners = (
        salt_winners.repartition("digest")
        .groupBy("digest", "body")
        .agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    )
    by_digest = stage(
        winners.groupBy("digest").agg(
            F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.count("*").alias("contents")
        ),
        "exact-winners",
    )
    clashing = by_digest.filter("contents > 1").select("digest")
    result = rows.select("doc_id", "digest", "body").join(by_digest.filter("contents = 1").drop("contents"), "digest")
    if not clashing.isEmpty():
        apart = rows.join(clashing, "digest", "left_semi")
        per_text = apart.groupBy("digest", "body").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        result = result.unionByName(apart.join(per_text, ["digest", "body"]))
    return result.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        sha256(F.col("body")).alias("text_sha256") if digest is not sha256 else F.col("digest").alias("text_sha256"),
    )


ORACLE = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
), g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.body) AS text_sha256
FROM t JOIN g USING (body)
"""
