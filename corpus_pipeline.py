"""The corpus pipeline: five stages over ``documents``, each one of the operators
of ``visitlens.llm``, written as Parquet and read again by the next.

1. language ID drops documents that fit no learned language;
2. near-dedup keeps one row of each group;
3. decontamination drops documents that hold a window of a benchmark item;
4. mixing repeats or drops documents so that each source gives its target in
   words: a document taken k times in full appears k times, and the one at a
   source's cut appears once more with the words up to the cut;
5. the rest are written as token ids in seekable frames and listed from there.

Each decision is about one row, whether its ``doc_id`` is its own, repeats or is
missing. A document that ends twice in the mix is two rows of equal ``doc_id``; the last
stage writes both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm import (decontamination, hyperminhash, language_id, source_mixing,
                           token_frames)
from visitlens.llm.common import Scratch, documents


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.recognised(docs)


def _numbered(spark: SparkSession, docs: DataFrame, name: str) -> DataFrame:
    """``row, doc``: the rows of ``docs``, each whole in one column, saved with a number,
    so that what is decided by row meets that row alone, also where a ``doc_id`` repeats
    or is missing, and no column of ``docs`` can meet a name that is used here."""
    return Scratch(spark, name).save(docs.select(
        F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")), "rows")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: of its smallest ``doc_id``, one without
    only where the whole group lacks them. Rows are searched by their number, so
    those that repeat or lack a ``doc_id`` are texts like others; rows without words
    are copies if they share a ``doc_id``."""
    rows = _numbered(spark, docs, "near-dedup-input")
    found = hyperminhash.near_duplicates(rows.select(F.col("row").alias("doc_id"), "doc.text"))
    found = found.select(F.col("doc_id").alias("row"), "n_shingles", "component_id").join(
        rows.select("row", "doc.doc_id"), "row")
    same = F.expr("n_shingles = 0 AND doc_id IS NOT NULL")
    kept = found.groupBy(F.when(same, F.col("doc_id")).alias("empty"),
                         F.when(~same, F.col("component_id")).alias("group")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first"))
    return rows.join(kept.select(F.col("first.row").alias("row")), "row", "left_semi").select("doc.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.uncontaminated(docs, benchmark)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _numbered(spark, docs, "mixing-input")
    sizes = source_mixing.sized(rows.select("row", "doc.doc_id", "doc.source", "doc.text"), "row")
    mixed = source_mixing.mix(sizes, rows="row").select("row", "size", "taken")
    word = "[^\\x20\\x09-\\x0D]+"
    rest = F.col("taken") % F.greatest("size", F.lit(1))
    full = F.floor(F.col("taken") / F.greatest("size", F.lit(1))).cast("int")
    copies = F.when(full > 0, F.array_repeat(F.lit(-1).cast("long"), full)).otherwise(
        F.array().cast("array<bigint>"))
    copies = F.concat(copies, F.when(rest > 0, F.array(rest)).otherwise(
        F.array().cast("array<bigint>")))
    taken = rows.join(mixed.filter("taken > 0"), "row").withColumn("cut", F.explode(copies))
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col("doc.text"), F.lit(word), F.lit(0)),
                               F.lit(1), F.greatest(F.lit(1), F.col("cut")).cast("int")), " ")
    text = F.when(F.col("cut") < 0, F.col("doc.text")).otherwise(cut)
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length(text).cast(dict(docs.dtypes)["n_chars"])
    return taken.select(*[changed.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_frames.token_frames(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_frames", write_token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs


#: Language models, hashed sketches and tokenizers are beyond SQL.
ORACLE_SQL = None
