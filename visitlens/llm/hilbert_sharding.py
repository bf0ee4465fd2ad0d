"""Sharding along a Hilbert curve (operator 2).

Each row's metadata are quantised to ``BITS`` bits a dimension at cut points
that are quantiles over all rows (one mergeable sketch per dimension), the cell
is mapped to its index on the Hilbert curve, rows are range-sorted by (index,
text hash, ``doc_id``) and the order is cut into runs of equal row counts.
Neighbours on the curve are neighbours in every dimension, so a run covers a
small box and min/max statistics of its files prune on each of the dimensions.

Law: ``rows`` - shard counts are at most one apart. Equal texts have equal size
and hash and lie next to each other in the order if their other metadata agree;
a group of any size can be cut at a shard border, so no hot group fills a shard
or a task. Only sizes, hashes and codes are sorted, never texts.

Defined results: NULL text has size 1 and the hash of the empty text; NULL
metadata share the lowest cell; rows equal in every sort key are interchangeable;
an empty table gives no rows; with fewer rows than shards the last shards are
empty.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from visitlens.llm.common import Scratch, documents

BITS = 5
SHARDS = 8
DIMENSIONS = ("source", "lang", "size", "doc_id")


def hilbert_index(axes: list[Column], bits: int) -> Column:
    """Index on the Hilbert curve of a cell, after Skilling's transpose method."""
    n = len(axes)
    steps = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i"))
                      for b in range(bits - 1, 0, -1) for i in range(n)])

    def undo(x: Column, s: Column) -> Column:
        low, first, own = s["q"] - 1, F.get(x, F.lit(0)), F.get(x, s["i"])
        swap = first.bitwiseXOR(own).bitwiseAND(low)
        return F.when(own.bitwiseAND(s["q"]) != 0, F.transform(
            x, lambda v, j: F.when(j == 0, v.bitwiseXOR(low)).otherwise(v))
        ).otherwise(F.transform(x, lambda v, j: F.when(
            ((j == 0) | (j == s["i"])) & (s["i"] != 0), v.bitwiseXOR(swap)).otherwise(v)))

    x = F.aggregate(steps, F.array(*[a.cast("int") for a in axes]), undo)
    gray = F.transform(x, lambda v, j: F.aggregate(
        F.slice(x, F.lit(1), j + 1), F.lit(0), lambda a, b: a.bitwiseXOR(b)))
    tops = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)])

    def bits_of(g: Column) -> Column:
        last = F.get(g, F.lit(n - 1))
        flip = F.aggregate(tops, F.lit(0), lambda t, q: F.when(
            last.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t))
        return F.transform(g, lambda v: v.bitwiseXOR(flip))

    places = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i"))
                       for b in range(bits - 1, -1, -1) for i in range(n)])
    done = F.transform(F.array(gray), bits_of)
    flat = F.get(done, F.lit(0))
    return F.get(F.transform(F.array(flat), lambda g: F.aggregate(
        places, F.lit(0).cast("long"), lambda h, s: h * 2 + F.when(
            F.get(g, s["i"]).bitwiseAND(s["q"]) != 0, 1).otherwise(0))), F.lit(0))


def _number(c: str, kind: str, common: int) -> Column:
    """An order-preserving number; of strings, six bytes past the common prefix."""
    if kind != "string":
        return F.col(c).cast("double")
    part = F.substring(F.col(c).cast("binary"), common + 1, 6)
    return F.conv(F.rpad(F.hex(part), 12, "0"), 16, 10).cast("double")


def _common_prefix(low: str | None, high: str | None) -> int:
    a, b = (low or "").encode(), (high or "").encode()
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def quantised(rows: DataFrame, dimensions: tuple[str, ...], bits: int) -> list[Column]:
    """A code of ``bits`` bits per dimension, cut at quantiles over all rows."""
    kinds = {c: dict(rows.dtypes)[c] for c in dimensions}
    texts = [c for c in dimensions if kinds[c] == "string"]
    common = dict.fromkeys(dimensions, 0)
    if texts:
        ends = rows.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in texts for f in (F.min, F.max)])
        row = ends.first()
        common |= {c: _common_prefix(row[f"min_{c}"], row[f"max_{c}"]) for c in texts}
    numbers = {c: _number(c, kinds[c], common[c]) for c in dimensions}
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = rows.agg(*[F.percentile_approx(numbers[c], shares, 10000).alias(c)
                      for c in dimensions]).first()

    def code(c: str) -> Column:
        found = sorted(set(cuts[c] or []))
        above = [F.when(numbers[c] > v, 1).otherwise(0) for v in found]
        return F.when(numbers[c].isNull(), 0).otherwise(reduce(lambda a, b: a + b, above, F.lit(0)))

    return [code(c) for c in dimensions]


def hilbert_shards(rows: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS,
                   ties: tuple[str, ...] = ("text_crc32", "doc_id"), shards: int = SHARDS,
                   bits: int = BITS) -> DataFrame:
    """``rows`` with ``curve``, ``shard`` and ``slot``; ``rows`` should be narrow."""
    scratch = Scratch(rows.sparkSession, "hilbert")
    rows = scratch.save(rows, "rows")
    curve = hilbert_index(quantised(rows, dimensions, bits), bits)
    ordered = scratch.save_sorted(rows.withColumn("curve", curve), ["curve", *ties], "ordered")
    # one row per range of the sort, not per input row
    counts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = scratch.save(counts.select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy()).alias("total")), "offsets")
    rank, total = F.col("before") + F.col("pos"), F.col("total")
    size, more = F.floor(total / shards), total % shards
    late = rank - more * (size + 1)
    shard = F.when(late < 0, F.floor(rank / (size + 1))).otherwise(
        more + F.floor(late / F.greatest(size, F.lit(1))))
    slot = F.when(late < 0, rank % (size + 1)).otherwise(late % F.greatest(size, F.lit(1)))
    return (ordered.join(offsets, "part")
            .withColumn("shard", shard.cast("int")).withColumn("slot", slot.cast("long"))
            .drop("part", "pos", "before", "total"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = documents(spark, sf_dir).select(
        "doc_id", "source", "lang", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"))
    return hilbert_shards(rows).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve")
