"""visitlens: web-visit attribution and per-SKU traffic marts on Spark.

Two batch products, both expressed as DataFrame plans:

* the visit marketing mart (:func:`visitlens.plans.visit_mart.build_visit_mart`)
  - first touch per visit, attribution repair through abandoned carts, campaign
  parameters from landing URLs, order economics and a resolved marketing channel;
* the SKU traffic mart (:func:`visitlens.plans.sku_mart.build_sku_mart`) - ad
  impressions, pageviews, orders, revenue and profit per product SKU.

Every URL parser is a ``Column -> Column`` function built from native Spark
functions, so all work stays inside whole-stage codegen; there is no Python UDF.
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
