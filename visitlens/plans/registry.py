"""

K3 (``sink_insert_into``) takes the place of the JDBC round trip. The scale paths
of the marts (visits split over tasks, dimensions too large to broadcast) are
registered as well and must reproduce the plain marts, and ``daily_chain`` runs
the SKU job over the mart that the visit job wrote. Every query reads the
test-data stand-ins over ``sf_dir`` and runs over whole tables. Parameters (fixed here so results are reproducible): the visit job at
``as_of`` 2024-01-31 with a 14-day window, the SKU job at ``as_of`` 2024-05-17
(window from 2024-01-15).
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens import config as C
from visitlens.config import SiteRules, SkuMartConfig, VisitMartConfig
from visitlens.functions.lookback import trailing_days
from visitlens.functions.orders import order_part
from visitlens.functions.params import url_param_columns
from visitlens.functions.urls import (ad_sku, catalog_item_id, category_id, clean_url,
                                      container_id, container_join_key, product_identifier,
                                      site_from_id, site_from_url, strip_sku_text, url_path,
                                      visit_sku)
from visitlens.operators import touch
from visitlens.operators.impressions import (impressions_by_sku, months_window,
                                             pla_impressions, text_impressions)
from visitlens.operators.joins import left_join_nullable_key
from visitlens.operators.pages import (money_as_double, order_facts_union, page_facts,
                                       page_facts_by_item)
from visitlens.operators.repair import attribution_repair
from visitlens.operators.sales import visit_sales
from visitlens.plans import sku_mart as sm
from visitlens.plans import visit_mart as vm
from visitlens.session import scratch_path
from visitlens.sinks import read_partitioned, write_partitioned
from visitlens.sources.tables import TestdataTables

VISIT_AS_OF = dt.date(2024, 1, 31)
VISIT_DAYS = 14
SKU_AS_OF = dt.date(2024, 5, 17)

Query = Callable[[SparkSession, str], DataFrame]


def visit_cfg(as_of: dt.date = VISIT_AS_OF) -> VisitMartConfig:
    return VisitMartConfig(as_of=as_of, site_rules=SiteRules(), days=VISIT_DAYS)


def sku_cfg() -> SkuMartConfig:
    return SkuMartConfig(as_of=SKU_AS_OF)


# --- visit job -----------------------------------------------------------------

def q_union_logs(spark, sf_dir):
    t = TestdataTables(spark, sf_dir)
    return touch.union_logs(t["visit_events"], t["visit_actions"], VISIT_AS_OF, VISIT_DAYS)


# rules that split the test data: cutover mid-month, early rules matching some URLs
SPLIT_SITE_RULES = SiteRules(cutover=dt.date(2024, 1, 15),
                             early_prefixes=("https://m.shop.example",),
                             early_hosts=(".shop.example/products",))


def q_site_rules(spark, sf_dir):
    a = TestdataTables(spark, sf_dir)["visit_actions"]
    return a.select("datetime_est", "visit_id", "url", "site_id",
                    site_from_url("url", "datetime_est", SPLIT_SITE_RULES).alias("site"),
                    site_from_id("site_id").alias("site_class"))


def q_first_touch(spark, sf_dir):
    return vm.visit_touches(TestdataTables(spark, sf_dir), visit_cfg())


def q_latest_cart(spark, sf_dir):
    t = TestdataTables(spark, sf_dir)
    return touch.donor_carts(touch.latest_carts(t["carts"]), vm.visit_touches(t, visit_cfg())) \
        .select("visit_id", "visitor_ip", "item_sku", "url")


def q_attribution_repair(spark, sf_dir):
    t = TestdataTables(spark, sf_dir)
    touches = vm.shared_touches(t, visit_cfg())
    donors = touch.donor_carts(touch.latest_carts(t["carts"]), touches, with_attributes=True)
    return attribution_repair(touches, t["goals"], t["order_items"], donors)


def q_attribution_override(spark, sf_dir):
    return vm.end_data(TestdataTables(spark, sf_dir), visit_cfg())


def q_url_params(spark, sf_dir):
    w = TestdataTables(spark, sf_dir)["web"]
    return w.select("event_id", "url", *url_param_columns("url"))


def q_order_id_part(spark, sf_dir):
    o = TestdataTables(spark, sf_dir)["visit_orders"]
    return o.select("visit_id", "order_id", order_part("order_id", 3).alias("demand_order_id"))


def _sales(t):
    return visit_sales(t["visit_orders"], t["profit_loss"], VISIT_AS_OF, VISIT_DAYS)


def _f_data(t):
    cfg = visit_cfg()
    return vm.with_url_params(vm.end_data(t, cfg), cfg.product_id_null_on_miss)


def q_visit_sales(spark, sf_dir):
    return _sales(TestdataTables(spark, sf_dir))


def q_visits_full_sales(spark, sf_dir):
    t = TestdataTables(spark, sf_dir)
    return vm.join_sales(_f_data(t), _sales(t)).select(
        "report_datetime", "visit_id", "url", "site", "mms_channel_id", "demand_order_id",
        "order_id", "net_revenue", "cancel_orders", "is_order_cancelled")


def q_mart_right_outer(spark, sf_dir):
    t = TestdataTables(spark, sf_dir)
    cfg = visit_cfg()
    visits_window = t["visits"].where(
        trailing_days("first_action_datetime_est", cfg.as_of, cfg.days))
    j = vm.attach_to_visits(visits_window, _f_data(t), _sales(t))
    return j.select("date_est", "visit_id", "order_id", "site_id",
                    F.lit(cfg.store_id).alias("sub_store_id"), F.lit(cfg.store_id).alias("store_id"),
                    "visitor_ip", "first_action_datetime_est", "actions",
                    F.lit("").alias("site_url"), "first_action_date_est")


def q_channel_rules(spark, sf_dir):
    t = TestdataTables(spark, sf_dir)
    ch = vm.with_channel(_f_data(t), visit_cfg())
    return ch.select("visit_id", "url", *touch.VISIT_ATTRIBUTES, "mms_channel_id",
                     "is_google_display_ad")


def q_channel_label(spark, sf_dir):
    t = TestdataTables(spark, sf_dir)
    ch = vm.with_channel(_f_data(t), visit_cfg())
    return ch.groupBy("mms_channel_id", "channel").agg(F.count(F.lit(1)).alias("visits"))


def q_visit_mart(spark, sf_dir):
    return vm.build_visit_mart(TestdataTables(spark, sf_dir), visit_cfg())


def q_sink_partitioned(spark, sf_dir):
    """K1: two daily runs into one table; the second replaces only its dates."""
    path = scratch_path(spark, "visit-mart")
    for as_of in (dt.date(2024, 1, 24), VISIT_AS_OF):
        mart = vm.build_visit_mart(TestdataTables(spark, sf_dir), visit_cfg(as_of))
        write_partitioned(mart, path, by="first_action_date_est", cluster=True, sort=("date_est",))
    back = read_partitioned(spark, path)
    return back.select(*[c for c in mart.columns])


# --- SKU job -------------------------------------------------------------------

def q_clean_url(spark, sf_dir):
    w = TestdataTables(spark, sf_dir)["web"]
    return w.select("event_id", "url", url_path("url").alias("url_path"),
                    clean_url("url").alias("clean_url"))


def q_container_ids(spark, sf_dir):
    w = TestdataTables(spark, sf_dir)["web"]
    path = url_path("url")
    return w.select("event_id", "url",
                    container_id(path, C.AD_CONTAINER_TEST).alias("ad_container_id"),
                    container_join_key(path).alias("container_key"),
                    container_id(clean_url("url"), C.VISIT_CONTAINER_TEST)
                    .alias("visit_container_id"))


def q_category_catalog_ids(spark, sf_dir):
    t = TestdataTables(spark, sf_dir)
    w = t["web"].select("event_id", "url", category_id("url").alias("category_id"),
                        catalog_item_id("url").alias("url_catalog_item_id"),
                        container_id(clean_url("url"), C.VISIT_CONTAINER_TEST).alias("container_id"))
    ci = t["container_items"].select(F.col("container_id").cast("string").alias("ci_container"),
                                     F.col("catalog_item_id").cast("string").alias("map_catalog"))
    j = left_join_nullable_key(w, ci, "container_id", "ci_container")
    return j.select("event_id", "url", "category_id", "url_catalog_item_id", "container_id",
                    F.coalesce("url_catalog_item_id", "map_catalog").alias("catalog_item_id"))


def q_sku_from_url(spark, sf_dir):
    w = TestdataTables(spark, sf_dir)["web"]
    ad_site = F.when(F.col("k") % 3 == 2, F.lit(C.LEGACY)).otherwise(F.lit(C.NEXTGEN))
    vsku = visit_sku("site_id", clean_url("url"))
    return w.select("event_id", "url", "site_id",
                    ad_sku(ad_site, url_path("url")).alias("ad_sku"),
                    vsku.alias("visit_sku"),
                    product_identifier("site_id", clean_url("url")).alias("product_identifier"),
                    strip_sku_text(vsku).alias("stripped_sku"))


def q_months_window(spark, sf_dir):
    cfg = sku_cfg()
    return months_window(TestdataTables(spark, sf_dir)["ads_hourly"], cfg.as_of, cfg.months,
                         cfg.lag_days)


def _text(t, cfg):
    return text_impressions(t["ads_hourly"], t["container_items"], t["sku_map"], cfg)


def _pla(t, cfg):
    return pla_impressions(t["pla_hourly"], t["campaigns"], t["sku_map"], t["products"], cfg)


def q_text_impressions(spark, sf_dir):
    return _text(TestdataTables(spark, sf_dir), sku_cfg())


def q_pla_impressions(spark, sf_dir):
    return _pla(TestdataTables(spark, sf_dir), sku_cfg())


def q_impressions_by_sku(spark, sf_dir):
    t, cfg = TestdataTables(spark, sf_dir), sku_cfg()
    return impressions_by_sku(_text(t, cfg), _pla(t, cfg), cfg.dedupe_impressions)


def _facts(t, cfg):
    return order_facts_union(t["visit_mart_legacy"], t["visit_mart"], cfg)


def q_order_facts_union(spark, sf_dir):
    return _facts(TestdataTables(spark, sf_dir), sku_cfg())


def q_page_facts(spark, sf_dir):
    t, cfg = TestdataTables(spark, sf_dir), sku_cfg()
    return money_as_double(page_facts(t["visit_actions"], _facts(t, cfg), cfg))


def q_page_facts_by_item(spark, sf_dir):
    t, cfg = TestdataTables(spark, sf_dir), sku_cfg()
    return money_as_double(page_facts_by_item(
        page_facts(t["visit_actions"], _facts(t, cfg), cfg), t["container_items"], cfg))


def q_sku_mart(spark, sf_dir):
    return sm.build_sku_mart(TestdataTables(spark, sf_dir), sku_cfg())


QUERIES: dict[str, Query] = {
    "union_logs": q_union_logs,
    "site_rules": q_site_rules,
    "first_touch": q_first_touch,
    "latest_cart": q_latest_cart,
    "attribution_repair": q_attribution_repair,
    "attribution_override": q_attribution_override,
    "url_params": q_url_params,
    "order_id_part": q_order_id_part,
    "visit_sales": q_visit_sales,
    "visits_full_sales": q_visits_full_sales,
    "mart_right_outer": q_mart_right_outer,
    "channel_rules": q_channel_rules,
    "channel_label": q_channel_label,
    "visit_mart": q_visit_mart,
    "clean_url": q_clean_url,
    "container_ids": q_container_ids,
    "category_catalog_ids": q_category_catalog_ids,
    "sku_from_url": q_sku_from_url,
    "months_window": q_months_window,
    "text_impressions": q_text_impressions,
    "pla_impressions": q_pla_impressions,
    "impressions_by_sku": q_impressions_by_sku,
    "order_facts_union": q_order_facts_union,
    "page_facts": q_page_facts,
    "page_facts_by_item": q_page_facts_by_item,
    "sku_mart": q_sku_mart,
    "sink_partitioned": q_sink_partitioned,
}


def q_sink_insert_into(spark, sf_dir):
    """K3: the same two runs through ``insertInto`` of a partitioned catalog table."""
    from visitlens.sinks import write_insert_into

    path = scratch_path(spark, "visit-mart-table")
    table = "visit_mart_k3_" + path.rsplit("-", 1)[-1]
    cfg = visit_cfg()
    first = vm.build_visit_mart(TestdataTables(spark, sf_dir), visit_cfg(dt.date(2024, 1, 24)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in first.schema.fields)
    spark.sql(f"CREATE TABLE {table} ({schema}) USING parquet "
              f"PARTITIONED BY (first_action_date_est) LOCATION '{path}'")
    write_insert_into(first, table, by="first_action_date_est", cluster=True)
    second = vm.build_visit_mart(TestdataTables(spark, sf_dir), cfg)
    write_insert_into(second, table, by="first_action_date_est", cluster=True)
    spark.sql(f"DROP TABLE {table}")     # the files stay
    return spark.read.parquet(path).select(*second.columns)


QUERIES["sink_insert_into"] = q_sink_insert_into


def q_visit_mart_salted(spark, sf_dir):
    """The visit mart with every visit of more than two orders in the window split;
    some orders lack a visit. Must equal the plain mart."""
    cfg = dataclasses.replace(visit_cfg(), sales_rows_per_task=2)
    return vm.build_visit_mart(TestdataTables(spark, sf_dir), cfg)


def q_sku_mart_shuffled(spark, sf_dir):
    """The SKU mart with no dimension small enough to broadcast."""
    cfg = dataclasses.replace(sku_cfg(), broadcast_max_rows=0)
    return sm.build_sku_mart(TestdataTables(spark, sf_dir), cfg)


def q_daily_chain(spark, sf_dir):
    """Both jobs: the SKU mart over the visit mart that was written before it."""
    t = TestdataTables(spark, sf_dir)
    path = scratch_path(spark, "chain-visit-mart")
    write_partitioned(vm.build_visit_mart(t, visit_cfg()), path, by="first_action_date_est",
                      cluster=True, sort=("date_est",))
    t.with_table("visit_mart", read_partitioned(spark, path))
    return sm.build_sku_mart(t, sku_cfg())


QUERIES["visit_mart_salted"] = q_visit_mart_salted
QUERIES["sku_mart_shuffled"] = q_sku_mart_shuffled
QUERIES["daily_chain"] = q_daily_chain


#: Columns that the first of two runs lacks, as an older release would.
ADDED_COLUMNS = ("channel", "demand_profit")


def _evolving_mart(spark, sf_dir) -> str:
    """Two daily runs into one table, the second with more columns; the table's path."""
    path = scratch_path(spark, "evolving-visit-mart")
    for as_of, lacking in ((dt.date(2024, 1, 24), ADDED_COLUMNS), (VISIT_AS_OF, ())):
        mart = vm.build_visit_mart(TestdataTables(spark, sf_dir), visit_cfg(as_of))
        write_partitioned(mart.drop(*lacking), path, by="first_action_date_est", cluster=True,
                          sort=("date_est",))
    return path


def q_sink_evolving(spark, sf_dir):
    """K1, schema merge: the added columns are read back, NULL where the first run wrote."""
    back = read_partitioned(spark, _evolving_mart(spark, sf_dir))
    return back.select("visit_id", "date_est", "order_id", "net_revenue", *ADDED_COLUMNS,
                       "first_action_date_est")


def q_daily_chain_evolving(spark, sf_dir):
    """The SKU job over a mart table that got columns between two runs."""
    t = TestdataTables(spark, sf_dir)
    t.with_table("visit_mart", read_partitioned(spark, _evolving_mart(spark, sf_dir)))
    return sm.build_sku_mart(t, sku_cfg())


def q_visit_mart_bucketed(spark, sf_dir):
    """The visit mart over a master stored by visit id: no exchange of the master."""
    t, path = TestdataTables(spark, sf_dir), scratch_path(spark, "visits-by-id")
    table = "visits_by_id_" + path.rsplit("-", 1)[-1]
    vm.store_visits(t, table, 8, path)
    mart = vm.build_visit_mart(t, visit_cfg())
    spark.sql(f"DROP TABLE {table}")     # resolved by now, and the files stay
    return mart


QUERIES["sink_evolving"] = q_sink_evolving
QUERIES["daily_chain_evolving"] = q_daily_chain_evolving
QUERIES["visit_mart_bucketed"] = q_visit_mart_bucketed
