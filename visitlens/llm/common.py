"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.session import scratch_path

#: The white space of the text contracts: space, tab, LF, VT, FF, CR.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: What Python workers are started with, unless the job says otherwise: freed blocks of
#: some MB go back to the system. glibc raises its bounds to 32 MB a block as such blocks
#: come and go, and a worker then keeps the most that any stage took.
WORKER_ENV = {"MALLOC_MMAP_THRESHOLD_": str(4 << 20), "MALLOC_TRIM_THRESHOLD_": str(16 << 20)}


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package where it lies on the same path as here
    (local runs, a shared file system); elsewhere it comes with the job's files."""
    root = str(Path(__file__).resolve().parents[2])
    for name, value in {"PYTHONPATH": root, **WORKER_ENV}.items():
        spark.sparkContext.environment.setdefault(name, value)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


class Scratch:
    """Parquet tables in a fresh folder of the shared checkpoint folder.

    A saved table cuts the lineage: a lost executor costs the tasks that read
    the table, not the stages that made it.
    """

    def __init__(self, spark: SparkSession, name: str):
        importable(spark)
        self.spark = spark
        self.path = scratch_path(spark, name)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete one saved table that no later step reads."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def save_sorted(self, df: DataFrame, keys: list, name: str) -> DataFrame:
        """``df`` in the global order of ``keys``, saved with its place in it.

        Adds ``part`` (number of the range) and ``pos`` (place in the range, from 0).
        One range exchange; the ranges split equal leading keys as long as the later
        keys differ, so no value of one key can fill a task. ``df`` is saved first,
        as finding the ranges would compute it once more.
        """
        df = self.save(df, f"{name}-unsorted")
        place = F.monotonically_increasing_id()
        out = (df.orderBy(*keys).withColumn("_place", place)
               .withColumn("part", F.shiftright("_place", 33).cast("int"))
               .withColumn("pos", F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)))
               .drop("_place"))
        return self.save(out, name)


def pieces(batches, rows: int = 512):
    """Arrow batches in slices, so that what Python makes of one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def shared_folder(uri: str):
    """The file system and path of a folder, for workers."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)
