"""Attribution repair through abandoned carts.

A converting visit that arrived untracked (no campaign referrer, no campaign
markers in its landing URL) takes over the landing URL and campaign attributes
of the visit that most recently abandoned the same SKU from the same IP. As in
the original there is no time relation between the two visits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.operators.joins import broadcast_if_bounded
from visitlens.operators.touch import VISIT_ATTRIBUTES

# URL markers of an already tracked visit (lower-cased URL)
TRACKED_URL_MARKERS = ("%campaign%", "%chid%", "%utm_source%")
CAMPAIGN_REFERRER = "campaign"

REPAIR_COLUMNS = ["visit_date", "visit_id", "url", *VISIT_ATTRIBUTES]
OVERRIDE_COLUMNS = ["url", *VISIT_ATTRIBUTES]
END_DATA_COLUMNS = ["visit_id", "visitor_ip", "datetime_est", "site", *OVERRIDE_COLUMNS]


def untracked(referrer_type: Column, url: Column) -> Column:
    """F4 (buyer side): not a campaign referrer and no campaign markers in the URL.

    A NULL referrer type fails ``<>`` and is therefore never repaired.
    """
    u = F.lower(url)
    cond = referrer_type != F.lit(CAMPAIGN_REFERRER)
    for m in TRACKED_URL_MARKERS:
        cond = cond & ~u.like(m)
    return cond


def attribution_repair(touches: DataFrame, goals: DataFrame, order_items: DataFrame,
                       donors: DataFrame, max_goal_visits: int = 5_000_000) -> DataFrame:
    """J3-J6 + F4 + G1: repaired URL and attributes per converting visit.

    ``donors`` is :func:`~visitlens.operators.touch.donor_carts` with
    attributes. Output: one row per (visit date, visit, donor attributes) with
    the greatest donor URL; several rows per visit are possible.

    The goal join of the original only filters (its fan-out collapses in the
    grouping, and ``max`` ignores duplicates), so it is a semi join against
    the distinct goal visits: no goal x item pairs are ever built. Few visits have
    a goal, so these are sent to the first touches (behind a count: at most
    ``max_goal_visits``), which are filtered where they are read and exchanged only
    if they bought; beyond the bound both sides are exchanged.
    """
    buyers = touches.where(untracked(F.col("referrer_type"), F.col("url"))) \
        .select("visit_id", "visitor_ip", "datetime_est")
    goal_visits = broadcast_if_bounded(goals.select("visit_id").distinct(), max_goal_visits)
    buyers = buyers.join(goal_visits, "visit_id", "left_semi")
    bought = buyers.join(order_items.select("visit_id", "item_sku"), "visit_id", "inner")
    d = donors.where(F.col("url").isNotNull()).select(
        F.col("visitor_ip").alias("d_ip"),
        F.lower("item_sku").alias("d_sku"),
        F.col("url").alias("d_url"),
        *[F.col(c).alias(f"d_{c}") for c in VISIT_ATTRIBUTES])
    matched = bought.join(
        d, (F.col("visitor_ip") == F.col("d_ip")) & (F.col("item_sku") == F.col("d_sku")),
        "inner")
    return (matched
            .groupBy(F.to_date("datetime_est").alias("visit_date"), F.col("visit_id"),
                     *[F.col(f"d_{c}").alias(c) for c in VISIT_ATTRIBUTES])
            .agg(F.max("d_url").alias("url"))
            .select(*REPAIR_COLUMNS))


def apply_repair(touches: DataFrame, repairs: DataFrame) -> DataFrame:
    """J7 + P21 + G3: repaired value else own value, then distinct rows.

    Both sides are partitioned by ``visit_id`` after the join, and the distinct
    includes ``visit_id``, so the distinct adds no shuffle.
    """
    r = repairs.select("visit_id", *[F.col(c).alias(f"r_{c}") for c in OVERRIDE_COLUMNS])
    joined = touches.join(r, "visit_id", "left")
    return joined.select(
        "visit_id", "visitor_ip", "datetime_est", "site",
        *[F.coalesce(F.col(f"r_{c}"), F.col(c)).alias(c) for c in OVERRIDE_COLUMNS]
    ).distinct()
