"""Line dedup (operator 6): lines that several documents share stay in one.

Lines are exploded as 16-byte hashes of their keys (the line stripped of white
space at both ends, A-Z lower-cased; keys under ``min_chars`` code points are
left alone). Distinct documents are counted per hash from distinct (hash,
document) rows, with partial sums at both steps, and lines of at least
``min_docs`` documents are dropped from all but the smallest. The shared hashes
are written and joined back on plain exchanges, which adaptive execution splits
for a hot line; only hashes, ids and positions travel. Each text is shuffled
once, to meet its dropped positions, and reassembled from its other lines by
position.

Defined results: NULL and empty text are one empty line; rows without ``doc_id``
count as one document with the largest id; rows that repeat a ``doc_id`` are one
document with several texts, each with a result of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import SPACES, Scratch, ascii_lower, documents

MIN_CHARS = 10
#: A line is shared from this number of documents on.
MIN_DOCS = 2
NO_ID = (1 << 63) - 1


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"),
                       F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("_id"),
                       F.xxhash64(text).alias("_sig"))


def _line_hashes(keyed: DataFrame, min_chars: int) -> DataFrame:
    lines = keyed.select("_id", "_sig", F.posexplode(
        F.split(ascii_lower(F.col("text")), "\n", -1)).alias("_pos", "_line"))
    key = F.btrim("_line", F.lit(SPACES))
    return (lines.select("_id", "_sig", "_pos", key.alias("_key"))
            .filter(F.length("_key") >= min_chars)
            .select("_id", "_sig", "_pos", F.unhex(F.md5("_key")).alias("_hash")))


def shared_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``_hash, n_docs, _first``: the lines that at least ``min_docs`` documents hold, and
    the smallest of these.

    Distinct documents are counted in two steps, both with partial sums: rows of one
    (line, document) become one, then they are counted by line. No line's documents
    are gathered.
    """
    return lines.select("_hash", "_id").distinct().groupBy("_hash").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min("_id").alias("_first")).filter(
        F.col("n_docs") >= min_docs)


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, n_lines, n_dropped, text`` with the lines that at least ``min_docs``
    documents hold dropped, but for the smallest of these."""
    scratch = Scratch(docs.sparkSession, "line-dedup")
    keyed = _keyed(docs)
    lines = scratch.save(_line_hashes(keyed, min_chars), "lines")
    shared = scratch.save(shared_lines(lines, min_docs), "shared")
    dropped = scratch.save(
        lines.join(shared.drop("n_docs"), "_hash").filter("_id <> _first").select("_id", "_sig", "_pos"),
        "dropped")
    gone = dropped.groupBy("_id", "_sig").agg(F.collect_set("_pos").alias("_gone"))
    parts = F.split("text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_gone")
    return (keyed.join(gone, ["_id", "_sig"], "left")
            .select("doc_id", "text", "_gone", parts.alias("_lines"))
            .select("doc_id", F.size("_lines").cast("long").alias("n_lines"),
                    F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
                    F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(
                        F.transform(kept, lambda p: F.get("_lines", p)), "\n")).alias("text")))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
