"""The SKU traffic mart (the whole SKU job: J18-J20, G12, F16, F17, P20).

Data path::

    ads_hourly --J11 containers --J12 SKU map--> text impressions
    pla_hourly --J13 campaigns --J14 SKU map --J15 products--> PLA impressions
    text + PLA --distinct union, by lower(SKU)--> impressions
    visit mart + legacy mart --distinct union--> order facts
    visit_actions x order facts --per (visit, URL)--> page facts
    page facts --J17 containers, per (catalog item, SKU)--> item facts
    item facts --J18 SKU map --J19 products --J20 impressions--> per SKU totals

The original runs this as one remote SQL query and fills NULLs in a client-side
pandas frame; here the result stays a distributed DataFrame and the fill is
``na.fill(0)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.config import SkuMartConfig
from visitlens.functions.exact import merged_sum
from visitlens.functions.urls import not_exploit
from visitlens.operators.impressions import (impressions_by_sku, pla_impressions,
                                             text_impressions)
from visitlens.operators.joins import left_join_dimension, left_join_nullable_key
from visitlens.operators.pages import (MONEY_MEASURES, money_as_double, order_facts_union,
                                       page_facts, page_facts_by_item)
from visitlens.sources.tables import Tables

SKU_MART_COLUMNS = ["akeneo_sku", "pageviews", "net_orders", "cancel_orders", "net_revenue",
                    "cancel_revenue", "profit", "impressions"]


def impressions(t: Tables, cfg: SkuMartConfig) -> DataFrame:
    text = text_impressions(t["ads_hourly"], t["container_items"], t["sku_map"], cfg)
    pla = pla_impressions(t["pla_hourly"], t["campaigns"], t["sku_map"], t["products"], cfg)
    return impressions_by_sku(text, pla, cfg.dedupe_impressions)


def item_facts(t: Tables, cfg: SkuMartConfig) -> DataFrame:
    facts = order_facts_union(t["visit_mart_legacy"], t["visit_mart"], cfg)
    pages = page_facts(t["visit_actions"], facts, cfg)
    return page_facts_by_item(pages, t["container_items"], cfg)


def sku_totals(items: DataFrame, sku_map: DataFrame, products: DataFrame,
               imps: DataFrame, cfg: SkuMartConfig) -> DataFrame:
    """J18-J20 + F16 + F17 + G12 + P20.

    The SKU map and the product master are broadcast behind the row bound; beyond
    it, and for the impressions, rows without a key are spread over the tasks. The
    impressions table is derived (an aggregate per SKU); counting it up front
    would compute it twice, so its join is left to adaptive execution, which
    broadcasts it only if its measured shuffle output is small.
    """
    bounds = (cfg.broadcast_max_rows, cfg.broadcast_max_bytes)
    skus = sku_map.select(F.col("catalog_item_id").cast("string").alias("catalog_item_id"),
                          F.col("akeneo_sku").alias("map_sku"))
    prods = products.select(F.lower("akeneo_sku").alias("sku_key"),
                            F.col("akeneo_sku").alias("product_sku"))
    imp = imps.select(F.lower("akeneo_sku").alias("imp_key"), F.col("impressions").alias("imp"))
    j = left_join_dimension(items, skus, "catalog_item_id", *bounds)
    j = left_join_dimension(j.withColumn("sku_key", F.lower("akeneo_sku")), prods, "sku_key", *bounds)
    j = j.withColumn("shown_as", F.lower(F.coalesce("akeneo_sku", "map_sku")))
    j = left_join_nullable_key(j, imp, "shown_as", "imp_key")
    key = F.lower(F.coalesce("product_sku", "map_sku"))
    out = (j.where(key.isNotNull() & not_exploit("eurl"))
            .groupBy(key.alias("akeneo_sku"))
            .agg(F.sum("pageviews").alias("pageviews"),
                 F.sum("net_orders").alias("net_orders"),
                 F.sum("cancel_orders").alias("cancel_orders"),
                 *[merged_sum(c).alias(c) for c in MONEY_MEASURES],
                 F.max("imp").alias("impressions")))
    return money_as_double(out, 2).na.fill(0).select(*SKU_MART_COLUMNS)


def build_sku_mart(t: Tables, cfg: SkuMartConfig) -> DataFrame:
    """Per-SKU pageviews, orders, revenue, profit and ad impressions."""
    return sku_totals(item_facts(t, cfg), t["sku_map"], t["products"], impressions(t, cfg), cfg)
