"""Connected components of a graph in a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``node, label`` (smallest node reachable) of every node of ``links`` (a, b).

    Alternating large-star and small-star steps: each node's neighbours are
    re-linked to the smallest of them, first the larger ones, then all not larger.
    Every step is a grouping by node with partial aggregation and a join of plain
    tables, written to the shared folder; a node with very many links is met as a
    skewed join key, never gathered. It ends when a round changes no link.
    """
    def least(edges: DataFrame) -> DataFrame:
        return edges.groupBy("a").agg(F.min("b").alias("m"))

    both = links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = scratch.save(both, f"{name}-0")
    state, step = _state(edges), 0
    while True:
        step += 1
        # large-star: the larger neighbours of a node link to its smallest
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = scratch.save(least(sides).withColumn("m", F.least("a", "m")), f"{name}-{step}-low")
        large = scratch.save(
            sides.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct(), f"{name}-{step}-large")
        # small-star: a node and its smaller neighbours link to the smallest of them
        low = scratch.save(least(large), f"{name}-{step}-small-low")
        small = large.join(low, "a")
        new = small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b"))).distinct()
        edges = scratch.save(new, f"{name}-{step}")
        now = _state(edges)
        if now == state:
            break
        state = now
    # all links now lead to the smallest node of their component
    labels = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return scratch.save(labels.unionByName(roots), f"{name}-labels")


def _state(edges: DataFrame) -> tuple:
    """A digest of a table of distinct links: equal if no link changed."""
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                    F.bit_xor(F.xxhash64("b", "a"))).first()
    return tuple(row)
