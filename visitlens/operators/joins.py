"""Join helpers: size-checked broadcast and null-key-aware outer joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# default byte bound for a broadcast side (well under the 8 GB hard limit, and
# small enough to ship to every executor)
MAX_BROADCAST_BYTES = 256 * 1024 * 1024


def _row_bytes(df: DataFrame):
    """Approximate in-memory size of a row: string/binary lengths + 8 per other
    field; None if a field is nested, as its size is not known this way."""
    total = F.lit(16)
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t in ("array", "map", "struct", "variant"):
            return None
        if t in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        else:
            total = total + F.lit(8)
    return total


def has_at_most(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes now.

    One distributed aggregate: every task counts its rows and sums their sizes,
    and only one row per task reaches the final step. (A ``limit`` would funnel
    up to ``max_rows`` rows from every partition into a single task - the whole
    table, for a large one.) Measured on every call: a table may have grown since
    the last one.
    """
    size = _row_bytes(df)
    if size is None:
        return False
    n, total = df.agg(F.count(F.lit(1)), F.sum(size)).first()
    return n <= max_rows and (total or 0) <= max_bytes


def total_bytes(df: DataFrame) -> int:
    """Approximate in-memory size of ``df`` now, nested fields as long as their text.

    One distributed aggregate, like :func:`has_at_most`."""
    nested = [f.name for f in df.schema.fields
              if f.dataType.typeName() in ("array", "map", "struct", "variant")]
    size = _row_bytes(df.drop(*nested))
    for c in nested:
        size = size + F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0))
    return df.agg(F.sum(size.cast("long"))).first()[0] or 0


def broadcast_if_bounded(df: DataFrame, max_rows: int,
                         max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only when it has at most ``max_rows`` rows and ``max_bytes``
    bytes, measured on the columns that are shipped.

    Beyond the bound the frame is returned unhinted and the planner uses a
    shuffled join. Meant for dimension tables - catalog maps whose size follows
    the catalog, not the traffic.
    """
    return F.broadcast(df) if has_at_most(df, max_rows, max_bytes) else df


def left_join_dimension(left: DataFrame, dim: DataFrame, key: str, max_rows: int,
                        max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``left LEFT JOIN dim USING (key)``: broadcast if bounded, else shuffled with
    the rows that lack the key spread evenly."""
    own = f"_{key}"
    dim = dim.withColumnRenamed(key, own)
    if has_at_most(dim, max_rows, max_bytes):
        return left.join(F.broadcast(dim), F.col(key) == F.col(own), "left").drop(own)
    return left_join_nullable_key(left, dim, key, own).drop(own)


def left_join_nullable_key(left: DataFrame, right: DataFrame, left_key: str,
                           right_key: str) -> DataFrame:
    """``left LEFT JOIN right ON left[left_key] = right[right_key]``, each side read once.

    Rows whose key is NULL never match, yet a shuffled join would send all of them
    to one task (they hash alike). So the sides are dealt by the key and a second
    column: 0 where there is a key, on both sides, and a hash of the whole row
    where the left key is NULL. Rows without a key spread over all tasks, and one
    exchange of each side serves both kinds. (Equal rows without a key still meet;
    adaptive execution splits them, as they are the left side of a left join.)
    """
    row = [F.col(f"`{f.name}`") for f in left.schema.fields
           if f.dataType.typeName() not in ("map", "variant")]
    spread = F.when(F.col(left_key).isNull(), F.xxhash64(*row)).otherwise(F.lit(0).cast("long"))
    # of a column, not a constant: the optimizer would fold that into a filter of the left side
    none = F.when(F.col(right_key).isNull(), F.lit(1)).otherwise(F.lit(0)).cast("long")
    left = left.withColumn("_no_key", spread)
    right = right.withColumn("_no_right_key", none)
    return left.join(right, (F.col(left_key) == F.col(right_key))
                     & (F.col("_no_key") == F.col("_no_right_key")), "left").drop(
        "_no_key", "_no_right_key")


#: Split keys up to this number are broadcast to the sides that look them up.
MAX_SPLIT_KEYS = 1_000_000


class SplitKeys:
    """Keys with so many rows that one task should not hold them, and their buckets.

    ``keys`` is the one key column that the large side has its rows from: a key that
    occurs in it n times gets ``ceil(n / rows_per_task)`` buckets. One aggregate
    counts it (with partial sums, so no key is gathered) and the keys of several
    buckets, never NULL, are kept as a written table. With none, nothing is added to
    any side.

    All sides of all joins on the key are dealt by the key and a bucket number:
    :meth:`copied` puts a row into every bucket of its key, :meth:`dealt` into one by
    hash. As the rows of a key without buckets have the number 0, they are exchanged
    once however many joins follow.
    """

    def __init__(self, keys: DataFrame, rows_per_task: int):
        from visitlens.session import scratch_path

        spark, key = keys.sparkSession, keys.columns[0]
        large = (keys.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key"))
                 .agg(F.ceil(F.count(F.lit(1)) / rows_per_task).cast("int").alias("_buckets"))
                 .where("_buckets > 1"))
        path = scratch_path(spark, "split-keys")
        large.write.parquet(path)
        self.table = spark.read.schema(large.schema).parquet(path)
        self.any = not self.table.isEmpty()
        if self.any and has_at_most(self.table, MAX_SPLIT_KEYS):
            self.table = F.broadcast(self.table)

    def _looked_up(self, df: DataFrame, key: str) -> DataFrame:
        return df.join(self.table, F.col(key) == F.col("_key"), "left").drop("_key")

    def copied(self, df: DataFrame, key: str, bucket: str, split: str | None = None) -> DataFrame:
        """``df`` with each row in all buckets of its key (NULL keys in bucket 0), and
        whether there are several."""
        last = F.coalesce("_buckets", F.lit(1)) - 1
        out = self._looked_up(df, key).withColumn(bucket, F.explode(F.sequence(F.lit(0), last)))
        if split:
            out = out.withColumn(split, last > 0)
        return out.drop("_buckets")

    def dealt(self, df: DataFrame, key: str, bucket: str) -> DataFrame:
        """``df`` with each row in one bucket of its key, by a hash of the row."""
        n = F.coalesce("_buckets", F.lit(1))
        place = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), n).cast("int")
        return self._looked_up(df, key).withColumn(bucket, place).drop("_buckets")
