"""Mixing sources to target weights (operator 7).

Sources in code-point order (NULL last) weigh 1, 2, 3, 1, ...; targets share the
total number of words by weight, stop at ``MOST`` times what a source has, and
the excess goes to the others by weight until none is above. A source takes its
whole texts as often as its target holds them and cuts the last epoch exactly at
the budget: documents get hash-random keys, are range-sorted by (source, key),
and running sums inside each range plus the sums of the ranges before give every
document its place among the source's words. A source with a third of all rows
spans many ranges, as the key splits it. Only ids, keys and sizes are sorted.

Budgets are targets rounded to whole words. Keys are hashes of ``doc_id``, so
reruns agree. Defined results: NULL text and text without words have size 0 and
take 0; a source without words has target 0; rows that repeat a ``doc_id`` (or
lack one) are ordered by size and then interchangeable; an empty table gives no
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from visitlens.llm.common import Scratch, documents

WORD = "[^\\x20\\x09-\\x0D]+"
MOST = 3
WEIGHTS = 3


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, most: int = MOST, weights: int = WEIGHTS) -> DataFrame:
    """``source, source_size, target`` - one row per source, from ``source, size``.

    Capping and resharing by weight ends where every target is the smaller of the
    cap and level x weight with one common level; with sources sorted by cap over
    weight, the level is the first (words left) / (weight left) that does not
    exceed the next source's cap over weight.
    """
    own = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # windows over one row per source
    order = Window.orderBy(F.col("source").asc_nulls_last())
    own = own.withColumn("weight", (F.row_number().over(order) - 1) % weights + 1)
    own = own.withColumn("cap", F.col("source_size") * most)
    own = own.withColumn("ratio", F.col("cap") / F.col("weight"))
    whole = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    own = own.withColumn("try", left / weight_left)
    level = F.min(F.when(F.col("try") <= F.col("ratio"), F.struct("ratio", "try"))).over(whole)["try"]
    share = F.coalesce(level * F.col("weight"), F.col("cap").cast("double"))
    target = F.least(F.col("cap").cast("double"), share)
    return own.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, most: int = MOST, rows: str | None = None) -> DataFrame:
    """One row per row of ``docs``: its columns without ``text``, ``size``,
    ``source_size``, ``target``, ``taken``. ``docs`` needs ``doc_id, source, size``;
    ``rows`` names a column that numbers its rows, which then orders rows of one
    ``doc_id`` and size and lets ranges split them."""
    scratch = Scratch(docs.sparkSession, "mixing")
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    order = [F.col("source").asc_nulls_last(), "_key", "doc_id", "size", *([rows] if rows else [])]
    rows = scratch.save_sorted(docs.withColumn("_key", key), order, "rows").drop("_key")
    targets = scratch.save(source_targets(rows, most), "targets")
    # one row per source and range, then per range of that source
    parts = rows.groupBy("source", "part").agg(F.sum("size").alias("n"))
    before = (Window.partitionBy("source").orderBy("part")
              .rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("source", "part",
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    budget = F.floor(F.col("target") + 0.5)
    full = F.floor(budget / F.greatest("source_size", F.lit(1)))
    parts = scratch.save(
        parts.alias("p").join(targets.alias("t"), F.expr("p.source <=> t.source"))
        .select(F.col("p.source").alias("_source"), F.col("part").alias("_part"), "_offset",
                "source_size", "target", full.alias("_epochs"),
                (budget - full * F.col("source_size")).alias("_rest")), "parts")
    running = (Window.partitionBy("part", "source").orderBy("pos")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("_sum", F.sum("size").over(running))
    start = F.col("_offset") + F.col("_sum") - F.col("size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rest") - start))
    taken = (F.col("size") * F.col("_epochs") + last).cast("long")
    return (rows.join(parts, F.expr("part = _part AND source <=> _source"))
            .withColumn("taken", taken)
            .drop("part", "pos", "_part", "_source", "_offset", "_sum", "_epochs", "_rest"))


def sized(docs: DataFrame, *others: str) -> DataFrame:
    return docs.select("doc_id", "source", word_count(docs["text"]).alias("size"), *others)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(sized(documents(spark, sf_dir))).select(
        "doc_id", "size", "source_size", "target", "taken", "source")
