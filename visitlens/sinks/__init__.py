"""Sinks (K1-K3).

* K1 :func:`write_partitioned` - overwrite a date-partitioned table, replacing
  only the partitions present in the frame (dynamic partition overwrite).
* K2 :func:`write_jdbc` - replace a relational table with the frame.
* K3 :func:`write_insert_into` - ``insertInto`` an existing partitioned catalog
  table, again replacing only the partitions present.
"""

from __future__ import annotations

import json
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from visitlens.operators.joins import total_bytes


@contextmanager
def dynamic_overwrite(spark: SparkSession):
    """Overwrite only the partitions a write produces, whatever the session says."""
    key = "spark.sql.sources.partitionOverwriteMode"
    prev = spark.conf.get(key, None)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        if prev is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, prev)


def _clustered(df: DataFrame, by: str | None, cluster: bool, sort: tuple[str, ...] = ()) -> DataFrame:
    """Bring rows of one partition value together in tasks of even size, in order of
    ``sort`` inside each.

    The ``rebalance`` hint shuffles once by the partition column and lets adaptive
    execution split a large value and merge small ones from measured sizes; a range
    repartitioning would run the whole plan a second time to sample it.
    """
    if by and cluster:
        df = df.hint("rebalance", F.col(by))
    # the writer keeps an order that begins with the partition column
    return df.sortWithinPartitions(by, *sort) if by and sort else df


#: Folder beside a table's partitions that holds its schemas; readers of files skip it.
SCHEMAS = "_schemas"


def _schema_files(spark: SparkSession, path: str) -> list[str]:
    """The table's schema files in the order they were written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{SCHEMAS}")
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    return sorted(str(f.getPath().toString()) for f in system.listStatus(folder))


def stored_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema of a K1 table: every column that any run wrote."""
    files = _schema_files(spark, path)
    if not files:
        return None
    return StructType.fromJson(json.loads(spark.read.text(files[-1], wholetext=True).first()[0]))


def _grown(known: StructType | None, new: StructType, by: str) -> StructType:
    """``known`` with the columns that are only in ``new`` behind its own."""
    if known is None:
        return new
    types = {f.name.lower(): f.dataType for f in known.fields}
    for f in new.fields:
        old = types.get(f.name.lower(), f.dataType)
        if old.simpleString() != f.dataType.simpleString():
            raise ValueError(f"column {f.name} is {old.simpleString()} in the table, "
                             f"{f.dataType.simpleString()} in the frame")
    extra = [f for f in new.fields if f.name.lower() not in types]
    last = [f for f in known.fields if f.name.lower() == by.lower()]
    return StructType([f for f in known.fields if f not in last] + extra + last)


def write_partitioned(df: DataFrame, path: str, by: str, fmt: str = "parquet",
                      cluster: bool = False, sort: tuple[str, ...] = ()) -> None:
    """K1: overwrite the partitions of ``path`` that ``df`` contains.

    The table's schema is kept beside its data (``_schemas``, one small file for each
    change) and grows with the columns of ``df``: a column that a run adds is NULL in
    partitions written before, one that a run lacks is NULL in its partitions. A
    column of another type is refused before anything is written. The schema is
    written first, so a run that fails leaves at most a column without values.

    Without ``cluster`` the frame's own partitioning is kept (every task may then
    write a small file into every date it holds). ``sort`` orders the rows of every
    file, so that readers that filter on these columns skip row groups by their
    smallest and largest values.
    """
    spark = df.sparkSession
    files = _schema_files(spark, path)
    known = stored_schema(spark, path)
    schema = _grown(known, StructType([f for f in df.schema.fields if f.name != by]
                                      + [df.schema[by]]), by)
    if schema != known:
        spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode(
            "overwrite").text(f"{path}/{SCHEMAS}/{len(files):08d}")
    with dynamic_overwrite(spark):
        (_clustered(df, by, cluster, sort).write.format(fmt).mode("overwrite").partitionBy(by)
            .save(path))


def read_partitioned(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a K1 table back by its stored schema, without opening any footer first (the
    partition column is restored from the folder names). A table of another writer has
    no stored schema and is read by Spark's own rule."""
    schema = stored_schema(spark, path)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               num_partitions: int | None = None) -> None:
    """K2: replace ``table`` with the frame over JDBC (no index, like the original).

    ``num_partitions`` caps the number of concurrent connections.
    """
    # a shuffle, so that the stages before keep their own number of tasks
    out = df.repartition(num_partitions) if num_partitions else df
    out.write.jdbc(url=url, table=table, mode="overwrite", properties=properties or {})


def write_insert_into(df: DataFrame, table: str, by: str | None = None,
                      cluster: bool = False) -> None:
    """K3: ``insertInto`` an existing partitioned catalog table with overwrite.

    Columns are matched by position, so ``df`` must follow the table's order
    (partition column last).
    """
    with dynamic_overwrite(df.sparkSession):
        _clustered(df, by, cluster).write.mode("overwrite").insertInto(table)


#: A bucket of a stored table is one task's work: more rows than this get more buckets.
BUCKET_BYTES = 128 * 1024 * 1024


def buckets_for(df: DataFrame, buckets: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """``buckets``, or as large a multiple as keeps a bucket of ``df`` near ``bucket_bytes``.

    A table that needs more gets at least as many as a shuffle has partitions: Spark
    exchanges a side that has fewer again. Multiples of one number stay compatible.
    """
    spark = df.sparkSession
    needed = -(-total_bytes(df) // bucket_bytes)
    if needed <= buckets:
        return buckets
    needed = max(needed, int(spark.conf.get("spark.sql.shuffle.partitions")))
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return buckets * max(min(-(-needed // buckets), most // buckets), 1)


def store_bucketed(df: DataFrame, table: str, key: str, buckets: int,
                   path: str | None = None, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``df`` as a catalog table of files dealt by ``key``, sorted by it: ``buckets`` of
    them, or a multiple for a large ``df`` (:func:`buckets_for`).

    Joins and groupings on ``key`` read such a table without an exchange. Rows whose
    key is NULL share a bucket, so keep tables here whose key is an id. With ``path``
    the files lie there, and outlive the table's name.
    """
    buckets = buckets_for(df, buckets, bucket_bytes)
    out = (df.repartition(buckets, F.col(key)).write.format("parquet").mode("overwrite")
           .bucketBy(buckets, key).sortBy(key))
    (out.option("path", path) if path else out).saveAsTable(table)
    return df.sparkSession.table(table)
