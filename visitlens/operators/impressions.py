"""Ad impressions per SKU.

Dimension tables (container map, SKU map, campaigns, products) follow the
catalog, not the traffic; they are broadcast behind a row-count check
(:func:`~visitlens.operators.joins.left_join_dimension`) and fall back to
shuffled joins beyond it. The fact side is aggregated once, by the final key:
the original's first grouping (site, URL, container, category, catalog item,
SKU) followed by a re-grouping by SKU sums the same rows into the same SKU
totals.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.config import LEGACY, SkuMartConfig
from visitlens.functions.lookback import trailing_months
from visitlens.functions.urls import (ad_sku, catalog_item_id, container_join_key,
                                      is_product_page, ng_product_id, pla_product_id,
                                      url_path)
from visitlens.operators.joins import left_join_dimension

IMPRESSION_COLUMNS = ["akeneo_sku", "impressions"]


def _window(cfg: SkuMartConfig, col: str):
    return trailing_months(col, cfg.as_of, cfg.months, cfg.lag_days)


def text_impressions(ads: DataFrame, container_items: DataFrame, sku_map: DataFrame,
                     cfg: SkuMartConfig) -> DataFrame:
    """Text-ad impressions per SKU (SKU from the URL for the new site, else mapped)."""
    a = ads.where(F.col("ad_final_url").isNotNull()
                  & is_product_page("ad_final_url")
                  & _window(cfg, "date"))
    path = url_path("ad_final_url")
    a = a.select("site", path.alias("path"),
                 container_join_key(path).alias("container_key"),
                 catalog_item_id("ad_final_url").alias("url_catalog_item_id"),
                 "impressions")
    bounds = (cfg.broadcast_max_rows, cfg.broadcast_max_bytes)
    containers = container_items.select(
        F.col("container_id").cast("string").alias("container_key"),
        F.col("catalog_item_id").cast("string").alias("map_catalog_item_id"))
    skus = sku_map.select(
        F.col("catalog_item_id").cast("string").alias("catalog_item_id"),
        F.col("akeneo_sku").alias("map_sku"))
    a = left_join_dimension(a, containers, "container_key", *bounds).withColumn(
        "catalog_item_id", F.coalesce("url_catalog_item_id", "map_catalog_item_id"))
    a = left_join_dimension(a, skus, "catalog_item_id", *bounds)
    sku = F.coalesce(ad_sku("site", "path"), F.col("map_sku"))
    return (a.select(sku.alias("akeneo_sku"), "impressions")
             .where(F.col("akeneo_sku").isNotNull())
             .groupBy("akeneo_sku").agg(F.sum("impressions").alias("impressions")))


def pla_impressions(pla: DataFrame, campaigns: DataFrame, sku_map: DataFrame,
                    products: DataFrame, cfg: SkuMartConfig) -> DataFrame:
    """Shopping-ad impressions per SKU.

    Legacy items map through campaign -> catalog item -> SKU; new-site items
    carry ``ng<id>`` and map through the product master. Impressions are summed
    per (product id, mapped SKU) before the product join (sums are additive, so
    the product fan-out multiplies them exactly as row by row).
    """
    p = pla.where(_window(cfg, "date"))
    bounds = (cfg.broadcast_max_rows, cfg.broadcast_max_bytes)
    camp = campaigns.select(
        F.col("campaignid").cast("string").alias("campaign_key"),
        F.col("catalogitemid").alias("catalogitemid"))
    skus = sku_map.select(
        F.col("catalog_item_id").cast("string").alias("catalog_key"),
        F.col("akeneo_sku").alias("map_sku"))
    p = p.withColumn("campaign_key", F.when(F.col("site") == F.lit(LEGACY), F.col("product_item_id")))
    p = left_join_dimension(p, camp, "campaign_key", *bounds)
    p = p.withColumn("catalog_key", F.col("catalogitemid").cast("string"))
    p = left_join_dimension(p, skus, "catalog_key", *bounds)
    p = p.where(F.col("catalogitemid").isNotNull() | ng_product_id("product_item_id").isNotNull())
    per_item = (p.groupBy(pla_product_id("product_item_id", "site").alias("brightpearl_id"), "map_sku")
                 .agg(F.sum("impressions").alias("impressions")))
    prods = products.select("brightpearl_id", F.col("akeneo_sku").alias("product_sku"))
    joined = left_join_dimension(per_item, prods, "brightpearl_id", *bounds)
    sku = F.coalesce("map_sku", "product_sku")
    return (joined.select(sku.alias("akeneo_sku"), "impressions")
                  .where(F.col("akeneo_sku").isNotNull())
                  .groupBy("akeneo_sku").agg(F.sum("impressions").alias("impressions")))


def impressions_by_sku(text: DataFrame, pla: DataFrame, dedupe: bool = True) -> DataFrame:
    """U2 + G8 + P16: both sources per lower-cased SKU.

    ``dedupe=True`` keeps the original's distinct union: a SKU with the same
    count from both sources is counted once.
    """
    u = text.select(*IMPRESSION_COLUMNS).unionByName(pla.select(*IMPRESSION_COLUMNS))
    if dedupe:
        u = u.distinct()
    return (u.groupBy(F.lower("akeneo_sku").alias("akeneo_sku"))
             .agg(F.sum("impressions").alias("impressions")))


def months_window(ads: DataFrame, as_of: dt.date, months: int = 4, lag_days: int = 2) -> DataFrame:
    """F2 check: ad rows and impressions per day inside the trailing-months window."""
    return (ads.where(trailing_months("date", as_of, months, lag_days))
               .groupBy(F.to_date("date").alias("ad_date"))
               .agg(F.count(F.lit(1)).alias("ad_rows"), F.sum("impressions").alias("impressions")))
