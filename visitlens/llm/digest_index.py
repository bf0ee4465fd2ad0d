"""Exact dedup over a persistent digest index (operator 5).

The index is a Parquet table bucketed and sorted by digest, one row per digest:
``digest`` (lowercase hex SHA-256 of the normalised text) and ``keep_id`` (the
document that brought it in first). A batch of documents is reduced to its
distinct digests (partial aggregation, so a text with a third of all rows
reaches the shuffle as one row per task), anti-joined with the index by a
sort-merge join that shuffles the batch side only, and the digests that are new
are appended, each bucket getting one more sorted file.

Defined results: NULL text counts as empty text; rows of equal text and equal
``doc_id`` share one decision; a NULL ``doc_id`` never wins over a number, and
among equal texts that all lack a ``doc_id`` every row stays; an empty table
gives an empty result. Further columns of the input are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import Scratch, documents

BUCKETS = 64


def normalised_digest(text) -> F.Column:
    """Hex SHA-256 of the text with every run of white space as one space."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")
    return F.sha2(plain.cast("binary"), 256)


class DigestIndex:
    """The digest table under ``path``; a later session opens it by path again."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = "digest_index_" + hashlib.sha256(path.encode()).hexdigest()[:16]
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (digest STRING, keep_id BIGINT) "
                  f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) "
                  f"INTO {buckets} BUCKETS LOCATION '{path}'")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, digests: DataFrame) -> None:
        """Append the digests of one batch (``doc_id``, ``digest``) that are new."""
        batch = digests.groupBy("digest").agg(F.min("doc_id").alias("keep_id"))
        new = batch.join(self.table().select("digest").hint("merge"), "digest", "left_anti")
        (new.repartition(self.buckets, "digest").write.mode("append").format("parquet")
         .bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.path)
         .saveAsTable(self.name))
        self.spark.catalog.refreshTable(self.name)


def deduplicate(index: DigestIndex, digests: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per row of ``digests`` (``doc_id``, ``digest``) already in ``index``.

    The groups are written before the join with the rows, so that both sides are
    plain exchanges and adaptive execution can split a digest with very many rows.
    """
    sizes = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    groups = scratch.save(sizes.join(index.table(), "digest"), "groups")
    return digests.join(groups, "digest").select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def exact_dedup(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Deduplicate a whole table against a fresh index, in two batches by ``doc_id``.

    The lower half of the id range goes in first, so the document that stays is
    the one with the smallest id.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    digests = scratch.save(
        docs.select("doc_id", normalised_digest(docs["text"]).alias("digest")), "digests")
    low, high = digests.agg(F.min("doc_id"), F.max("doc_id")).first()
    index = DigestIndex(spark, f"{scratch.path}/index", buckets)
    middle = F.lit(None if low is None else low + (high - low) // 2).cast("long")
    first = F.coalesce(F.col("doc_id") <= middle, F.lit(False))
    index.add(digests.filter(first))
    index.add(digests.filter(~first))
    return deduplicate(index, digests, scratch)


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))
