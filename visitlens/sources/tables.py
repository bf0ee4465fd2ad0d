"""Input registry: logical table name -> DataFrame.

Operators never read storage themselves; they take DataFrames. A ``Tables``
object maps the logical input names used throughout the package to lazily
built DataFrames, so the same plans run on catalog tables, on parquet paths or
on the test-data stand-ins.

Logical names (schemas in FIXTURES.md section 1):

* visit mart inputs: ``visit_events``, ``visit_actions``, ``visits``, ``carts``,
  ``goals``, ``order_items``, ``visit_orders``, ``profit_loss``
* SKU mart inputs: ``ads_hourly``, ``pla_hourly``, ``container_items``,
  ``sku_map``, ``campaigns``, ``products``, ``visit_actions``,
  ``visit_mart_legacy``, ``visit_mart``
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from visitlens.session import session_conf
from visitlens.sources import standins


class Tables:
    """Base registry with per-name memoisation of the (lazy) DataFrames."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._cache: dict[str, DataFrame] = {}

    def _load(self, name: str) -> DataFrame:  # pragma: no cover - abstract
        raise NotImplementedError

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._load(name)
        return self._cache[name]

    def with_table(self, name: str, df: DataFrame) -> "Tables":
        """Override one input (e.g. feed a freshly built visit mart)."""
        self._cache[name] = df
        return self


class CatalogTables(Tables):
    """Inputs from the session catalog: ``names`` maps logical -> qualified name."""

    def __init__(self, spark: SparkSession, names: Mapping[str, str]):
        super().__init__(spark)
        self.names = dict(names)

    def _load(self, name: str) -> DataFrame:
        return self.spark.table(self.names.get(name, name))


class ParquetTables(Tables):
    """Inputs from parquet folders: ``paths`` maps logical name -> path."""

    def __init__(self, spark: SparkSession, paths: Mapping[str, str]):
        super().__init__(spark)
        self.paths = dict(paths)

    def _load(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.paths[name])


# (application id, sf dir, view) -> path of the stored view
_STORED: dict[tuple[str, str, str], str] = {}


class TestdataTables(Tables):
    """The stand-in views of :mod:`visitlens.sources.standins` over ``sf_dir``.

    The stand-ins play the production input tables, which are stored,
    multi-file tables. The generated test files, however, hold one row group
    each, so every scan of them is a single task, and a view would be derived
    again by every query that reads it. So each view named in ``store`` (by
    default all of them) is derived once per application and test-data folder,
    on first use, and written as a multi-file parquet table in the shared
    checkpoint folder; queries read it from there. Every query still does all
    of its own work on every run. Pass ``store=()`` to derive the views on the
    fly instead.

    Rows are dealt out where they are narrow: a base table before a view is
    derived from it. The views' own rows, of up to a hundred columns, are written
    by the tasks that made them, as the stored views they come from have several
    files already.
    """

    __test__ = False  # not a pytest class

    def __init__(self, spark: SparkSession, sf_dir: str,
                 store: tuple[str, ...] | None = None):
        super().__init__(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self.store = tuple(standins.VIEWS) if store is None else tuple(store)

    def prepare(self) -> "TestdataTables":
        """Store every view named in ``store`` now (instead of on first use)."""
        for name in standins.closure(self.store):
            self[name]
        return self

    def _derive(self, name: str, files: int | None = None) -> DataFrame:
        """The view; with ``files``, what it reads that is not stored is dealt to so many tasks."""
        if name in standins.BASE_TABLES or name not in standins.VIEWS:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        refs = {d: self[d] for d in standins.dependencies(name)}
        if files:
            refs = {d: df if d in self.store else df.repartition(files) for d, df in refs.items()}
        return self.spark.sql(standins.VIEWS[name], **refs)

    def _load(self, name: str) -> DataFrame:
        if name not in self.store:
            return self._derive(name)
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _STORED:
            from visitlens.session import scratch_path

            path = scratch_path(self.spark, f"standin-{name}")
            files = max(2 * self.spark.sparkContext.defaultParallelism, 2)
            # a view's exchanges carry narrow rows: their partitions are small beside what is written
            with session_conf(self.spark, "spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k"):
                self._derive(name, files).write.parquet(path)
            _STORED[key] = path
        return self.spark.read.parquet(_STORED[key])
