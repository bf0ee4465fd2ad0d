"""Page facts: product pageviews with order economics (S4, S17, S18, U3, J16, J17,
G9-G11, F7, F11-F13, P4, P7-P13, P17-P19).

The original joins every product-page action of a visit with every order fact
of that visit and then groups by (visit, URL). That credits each order to every
product URL of the visit, once per hit ("any-view attribution"). Here the same
numbers come without materialising action x order pairs: actions are counted
per (visit, URL, site) and order facts are aggregated per visit, then the two
aggregates are joined one-to-one and multiplied - a count over ``n x m``
joined rows is ``n`` times the count over the ``m`` facts, and likewise for
sums (NULL stays NULL). Both sides shrink map-side before any shuffle, so a
visit holding a large share of all actions costs one row per distinct URL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens import config as C
from visitlens.config import SkuMartConfig
from visitlens.functions.exact import (carried, exact_sum, held, merged_sum, rounded,
                                       times)
from visitlens.functions.lookback import trailing_months
from visitlens.functions.urls import (catalog_item_id, category_id, clean_url, container_id,
                                      is_product_page, last_segment, not_search,
                                      site_from_id, sku_from_path, strip_sku_text)
from visitlens.operators.joins import left_join_dimension

FACT_COLUMNS = ["visit_id", "order_id", "is_order_cancelled", "revenue", "profit"]
PAGE_MEASURES = ["cancel_orders", "net_orders", "cancel_revenue", "net_revenue", "profit"]
PAGE_COLUMNS = ["visit_id", "eurl", "url", "site", "container_id", "category_id",
                "catalog_item_id", "akeneo_sku", "product_identifier", *PAGE_MEASURES]
MONEY_MEASURES = ["net_revenue", "cancel_revenue", "profit"]
ITEM_COLUMNS = ["eurl", "catalog_item_id", "akeneo_sku", "pageviews", "net_orders",
                "cancel_orders", "net_revenue", "cancel_revenue", "profit"]


def _window(cfg: SkuMartConfig, col: str):
    return trailing_months(col, cfg.as_of, cfg.months, cfg.lag_days)


def order_facts_union(legacy: DataFrame, current: DataFrame, cfg: SkuMartConfig) -> DataFrame:
    """U3 + P18 + P19: distinct order facts of the legacy and the current visit mart."""
    old = legacy.where(_window(cfg, "date_est")).select(*FACT_COLUMNS)
    new = current.where(_window(cfg, "date_est")).select(
        "visit_id", "order_id", "is_order_cancelled",
        (F.col("net_revenue") + F.col("return_revenue") + F.col("cancelled_revenue")).alias("revenue"),
        F.col("demand_profit").alias("profit"))
    return old.unionByName(new).distinct()


def visit_order_totals(facts: DataFrame) -> DataFrame:
    """Per visit: the five G9 measures over its order facts, money as exact sums."""
    cancelled = F.col("is_order_cancelled") == F.lit(True)
    kept = F.col("is_order_cancelled") == F.lit(False)
    amounts = {"f_cancel_revenue": F.when(cancelled, F.col("revenue")),
               "f_net_revenue": F.when(kept, F.col("revenue")), "f_profit": F.col("profit")}
    facts = facts.withColumns({c: x.cast("double") for c, x in amounts.items()})
    facts = facts.withColumns({f"h{c}": held(c) for c in amounts})
    return facts.groupBy("visit_id").agg(
        F.count(F.when(cancelled, F.col("order_id"))).alias("f_cancel_orders"),
        F.count(F.when(kept, F.col("order_id"))).alias("f_net_orders"),
        *[exact_sum(c, f"h{c}").alias(c) for c in amounts]).withColumns(
        {c: carried(c) for c in amounts})


def page_facts(actions: DataFrame, facts: DataFrame, cfg: SkuMartConfig) -> DataFrame:
    """J16 + G9 + G10: one row per (visit, URL, site class) with order measures.

    The original's group keys are all functions of (visit, URL, site class), so
    grouping on those three gives the same groups. Money measures are exact sums
    (:mod:`visitlens.functions.exact`); :func:`money_as_double` rounds them.
    """
    a = actions.where(is_product_page("url", C.VISIT_PRODUCT_PAGE)
                      & _window(cfg, "datetime_est")
                      & ~F.col("site_id").isin(*cfg.excluded_site_ids)
                      & not_search("url"))
    views = (a.groupBy("visit_id", "url", site_from_id("site_id", cfg.sku_site_ids).alias("site"))
              .agg(F.count(F.lit(1)).alias("hits")))
    totals = visit_order_totals(facts)
    j = views.join(totals, "visit_id", "left")
    n = F.col("hits")
    clean = clean_url("url")
    # P12/P13 test the site id; after F11 the site class is the same test
    nextgen = F.col("site") == F.lit(C.NEXTGEN)
    return j.select(
        "visit_id", clean.alias("eurl"), "url", "site",
        container_id(clean, C.VISIT_CONTAINER_TEST).alias("container_id"),
        category_id("url").alias("category_id"),
        catalog_item_id("url").alias("catalog_item_id"),
        F.when(nextgen, sku_from_path(clean, C.VISIT_SUFFIX_CODES, C.VISIT_SUFFIX_STRIP))
         .alias("akeneo_sku"),
        F.when(~nextgen, last_segment(clean)).alias("product_identifier"),
        (F.coalesce(F.col("f_cancel_orders"), F.lit(0)) * n).alias("cancel_orders"),
        (F.coalesce(F.col("f_net_orders"), F.lit(0)) * n).alias("net_orders"),
        *[times(f"f_{c}", "hits").alias(c) for c in MONEY_MEASURES])


def page_facts_by_item(pages: DataFrame, container_items: DataFrame,
                       cfg: SkuMartConfig) -> DataFrame:
    """J17 + G11 + P10 + P17: per (catalog item, SKU) pageviews and measures.

    The group's representative URL (tested by F17 downstream) is the smallest
    one; the original takes an arbitrary element of the collected URL list, of
    which the smallest is one legal choice. No list is collected, so a SKU
    with billions of views still aggregates in constant memory per task.
    """
    containers = container_items.select(
        F.col("container_id").cast("string").alias("container_id"),
        F.col("catalog_item_id").cast("string").alias("map_catalog_item_id"))
    j = left_join_dimension(pages, containers, "container_id", cfg.broadcast_max_rows,
                            cfg.broadcast_max_bytes)
    cat = F.coalesce(F.col("catalog_item_id"), F.col("map_catalog_item_id"))
    return (j.groupBy(cat.alias("catalog_item_id"), F.col("akeneo_sku").alias("raw_sku"))
             .agg(F.min("eurl").alias("eurl"),
                  F.count("url").alias("pageviews"),
                  F.sum("net_orders").alias("net_orders"),
                  F.sum("cancel_orders").alias("cancel_orders"),
                  *[merged_sum(c).alias(c) for c in MONEY_MEASURES])
             .withColumn("akeneo_sku", strip_sku_text("raw_sku"))
             .select(*ITEM_COLUMNS))


def money_as_double(df: DataFrame, places: int = 6) -> DataFrame:
    """The exact money sums of page or item facts as doubles of ``places`` decimals."""
    df = df.withColumns({c: carried(c) for c in MONEY_MEASURES})
    return df.withColumns({c: rounded(c, places) for c in MONEY_MEASURES})
