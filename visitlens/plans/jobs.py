"""Job runners: the two original scheduled jobs as read -> build -> write.

* :func:`run_visit_mart` - the visit job: builds the mart for the trailing
  window and overwrites the touched date partitions of the mart table (K1).
* :func:`run_sku_mart` - the SKU job: builds the per-SKU mart and replaces the
  reporting table, over JDBC (K2) or as parquet.
* :func:`run_daily` - both, chained the way the original deployment chains
  them: the SKU job reads the visit mart back from the table the visit job
  wrote (a written table is also a lineage cut).

Command line::

    python -m visitlens.plans.jobs visit-mart --as-of 2024-01-31 --out PATH \
        --site-host www.shop.example --site-cutover 2023-06-30 \
        --table visits=db.visits --table visit_events=db.visit_events ...
    python -m visitlens.plans.jobs sku-mart --as-of 2024-05-17 \
        --jdbc-url jdbc:mysql://HOST/DB --jdbc-table sku_traffic \
        --jdbc-property user=... --table visit_mart=db.visit_mart ...
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from visitlens.config import SiteRules, SkuMartConfig, VisitMartConfig
from visitlens.plans.sku_mart import build_sku_mart
from visitlens.plans.visit_mart import build_visit_mart, store_visits
from visitlens.sinks import read_partitioned, write_jdbc, write_partitioned
from visitlens.sources.tables import CatalogTables, ParquetTables, Tables

PARTITION_KEY = "first_action_date_est"
# the SKU job filters on it: row groups outside its window are skipped
SORT_KEYS = ("date_est",)


def run_visit_mart(t: Tables, cfg: VisitMartConfig, out_path: str,
                   fmt: str = "parquet") -> None:
    """Visit job: overwrite the mart's date partitions for ``cfg``'s window."""
    mart = build_visit_mart(t, cfg)
    write_partitioned(mart, out_path, by=PARTITION_KEY, cluster=True, sort=SORT_KEYS, fmt=fmt)


def run_sku_mart(t: Tables, cfg: SkuMartConfig, out_path: str | None = None,
                 jdbc_url: str | None = None, jdbc_table: str | None = None,
                 jdbc_properties: dict[str, str] | None = None,
                 jdbc_connections: int | None = None) -> DataFrame:
    """SKU job: replace the reporting table (JDBC) and/or write parquet."""
    mart = build_sku_mart(t, cfg)
    if out_path:
        # written once; the database is then filled from the files
        mart.write.mode("overwrite").parquet(out_path)
        mart = t.spark.read.schema(mart.schema).parquet(out_path)
    if jdbc_url and jdbc_table:
        write_jdbc(mart, jdbc_url, jdbc_table, jdbc_properties, jdbc_connections)
    return mart


def run_daily(t: Tables, visit_cfg: VisitMartConfig, sku_cfg: SkuMartConfig,
              visit_mart_path: str, sku_mart_path: str, visit_buckets: int | None = None,
              visits_table: str = "visits_by_id") -> None:
    """Both jobs in order; the SKU job reads the freshly written visit mart.

    With ``visit_buckets``, the visit master is first stored by ``visit_id`` in so many
    buckets, or a multiple if it is large (table ``visits_table``), and the visit job
    reads it without an exchange."""
    if visit_buckets:
        store_visits(t, visits_table, visit_buckets)
    run_visit_mart(t, visit_cfg, visit_mart_path)
    t.with_table("visit_mart", read_partitioned(t.spark, visit_mart_path))
    run_sku_mart(t, sku_cfg, out_path=sku_mart_path)


def _parse(argv=None):
    p = argparse.ArgumentParser(prog="visitlens.plans.jobs")
    p.add_argument("job", choices=["visit-mart", "sku-mart", "daily"])
    p.add_argument("--as-of", required=True, type=dt.date.fromisoformat)
    p.add_argument("--out", help="output path of the (SKU) mart")
    p.add_argument("--visit-mart-out", help="daily: output path of the visit mart")
    p.add_argument("--days", type=int, default=45, help="visit job: days back")
    p.add_argument("--months", type=int, default=4, help="SKU job: months back")
    p.add_argument("--lag-days", type=int, default=2, help="SKU job: days before --as-of")
    p.add_argument("--format", default="parquet", help="visit-mart: file format")
    p.add_argument("--site-host", help="visit job: host of the new site")
    p.add_argument("--site-cutover", type=dt.date.fromisoformat,
                   help="visit job: last day of the early rules")
    p.add_argument("--site-early-prefix", action="append", default=[],
                   help="visit job: URL prefix of the new site up to the cutover (repeatable)")
    p.add_argument("--site-early-host", action="append", default=[],
                   help="visit job: host part of the new site up to the cutover (repeatable)")
    p.add_argument("--site-excluded-paths", help="visit job: regex of legacy paths")
    p.add_argument("--sales-rows-per-task", type=int, default=100_000,
                   help="visit job: split visits with more orders than this")
    p.add_argument("--missing-columns", choices=["error", "null"], default="error",
                   help="visit job: mart columns absent from the inputs")
    p.add_argument("--jdbc-url", help="sku-mart: replace a relational table at this URL")
    p.add_argument("--jdbc-table", help="sku-mart: the table to replace")
    p.add_argument("--jdbc-property", action="append", default=[],
                   help="key=value connection property (repeatable)")
    p.add_argument("--jdbc-connections", type=int, help="sku-mart: connections at once")
    p.add_argument("--table", action="append", default=[],
                   help="logical=qualified catalog name (repeatable)")
    p.add_argument("--path", action="append", default=[],
                   help="logical=path of a Parquet table (repeatable, in place of --table)")
    p.add_argument("--visit-buckets", type=int,
                   help="visit job: store the visit master by visit id in so many buckets "
                        "first (a multiple, if it is large)")
    p.add_argument("--visits-table", default="visits_by_id",
                   help="visit job: name of that stored table")
    return p.parse_args(argv)


def _visit_config(args) -> VisitMartConfig:
    if not args.site_host or not args.site_cutover:
        raise SystemExit("the visit job needs --site-host and --site-cutover")
    rules = SiteRules(cutover=args.site_cutover, host=args.site_host,
                      early_prefixes=tuple(args.site_early_prefix),
                      early_hosts=tuple(args.site_early_host))
    if args.site_excluded_paths:
        rules = dataclasses.replace(rules, excluded_paths=args.site_excluded_paths)
    return VisitMartConfig(as_of=args.as_of, site_rules=rules, days=args.days,
                           missing_columns=args.missing_columns,
                           sales_rows_per_task=args.sales_rows_per_task)


def main(argv=None) -> None:
    from visitlens.session import get_session

    args = _parse(argv)
    if args.job != "sku-mart" and not args.out:
        raise SystemExit(f"{args.job} needs --out")
    if args.job == "daily" and not args.visit_mart_out:
        raise SystemExit("daily needs --visit-mart-out")
    visit_cfg = _visit_config(args) if args.job != "sku-mart" else None
    sku_cfg = SkuMartConfig(as_of=args.as_of, months=args.months, lag_days=args.lag_days)
    spark: SparkSession = get_session(app_name=f"visitlens-{args.job}")
    t = CatalogTables(spark, dict(kv.split("=", 1) for kv in args.table))
    files = ParquetTables(spark, dict(kv.split("=", 1) for kv in args.path))
    for name in files.paths:
        t.with_table(name, files[name])
    if args.job == "visit-mart":
        if args.visit_buckets:
            store_visits(t, args.visits_table, args.visit_buckets)
        run_visit_mart(t, visit_cfg, args.out, args.format)
    elif args.job == "daily":
        run_daily(t, visit_cfg, sku_cfg, args.visit_mart_out, args.out, args.visit_buckets,
                  args.visits_table)
    else:
        props = dict(kv.split("=", 1) for kv in args.jdbc_property)
        run_sku_mart(t, sku_cfg, out_path=args.out, jdbc_url=args.jdbc_url,
                     jdbc_table=args.jdbc_table, jdbc_properties=props,
                     jdbc_connections=args.jdbc_connections)


if __name__ == "__main__":
    main()
