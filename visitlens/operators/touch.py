"""Visit logs, first touch and latest abandonment.

``first_by`` / ``last_by`` replace ``row_number() ... = 1``: the original picks
one row per key ordered by time. Here that is ``min``/``max`` of a struct
``(order columns..., tie-break columns...)`` per key - a hash aggregate with a
map-side partial step, so every task forwards at most one row per key and a key
holding a third of all rows costs no more than any other. The struct order is
ascending with NULL first, the same as ``ORDER BY ... ASC`` (and ``max`` gives
``DESC NULLS LAST``). The tie-break columns make the pick deterministic where
the original leaves ties open.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.config import SiteRules
from visitlens.functions.lookback import trailing_days
from visitlens.functions.urls import site_from_url

LOG_COLUMNS = ["datetime_est", "visitor_ip", "visit_id", "url"]
VISIT_ATTRIBUTES = ["campaign_source", "campaign_medium", "ad_provider_id",
                    "referrer_type", "referrer_name"]
FIRST_TOUCH_COLUMNS = ["datetime_est", "visitor_ip", "visit_id", "url", "site",
                       *VISIT_ATTRIBUTES]


def _pick(df: DataFrame, keys: list[str], order: list[str], payload: list[str],
          newest: bool) -> DataFrame:
    packed = F.struct(*[F.col(c) for c in order + payload]).alias("_row")
    agg = F.max(packed) if newest else F.min(packed)
    fields = [F.col(f"_row.{c}").alias(c) for c in order + payload]
    return df.groupBy(*keys).agg(agg.alias("_row")).select(*keys, *fields)


def first_by(df: DataFrame, keys: list[str], order: list[str],
             payload: list[str]) -> DataFrame:
    """One row per key: the first by ``order`` ascending, then by ``payload``."""
    return _pick(df, keys, order, payload, newest=False)


def last_by(df: DataFrame, keys: list[str], order: list[str],
            payload: list[str]) -> DataFrame:
    """One row per key: the last by ``order`` (i.e. ``ORDER BY ... DESC``)."""
    return _pick(df, keys, order, payload, newest=True)


def window_logs(events: DataFrame, actions: DataFrame, as_of: dt.date,
                days: int) -> DataFrame:
    """S3+S4+F1: both logs inside the trailing window, as one bag (UNION ALL)."""
    e = events.where(trailing_days("datetime_est", as_of, days)).select(*LOG_COLUMNS)
    a = actions.where(trailing_days("datetime_est", as_of, days)).select(*LOG_COLUMNS)
    return e.unionByName(a)


def union_logs(events: DataFrame, actions: DataFrame, as_of: dt.date, days: int,
               site_rules: SiteRules = SiteRules()) -> DataFrame:
    """Distinct union of the two logs, with the site class.

    The site is a function of columns already in the row, so it is computed
    once after the distinct instead of in each branch.
    """
    u = window_logs(events, actions, as_of, days).distinct()
    return u.withColumn("site", site_from_url("url", "datetime_est", site_rules))


def first_touch(logs: DataFrame, visits: DataFrame,
                site_rules: SiteRules = SiteRules()) -> DataFrame:
    """W1+F3+J1: each visit's earliest log row, with the visit's campaign attributes.

    ``logs`` may contain duplicates (a UNION ALL of the two logs): picking the
    first row per visit gives the same row whether or not exact duplicates were
    removed, so the distinct of U1 - a full shuffle of the log - is skipped.
    Ties on time are broken by URL, then visitor IP.
    """
    touch = first_by(logs, ["visit_id"], ["datetime_est"], ["url", "visitor_ip"])
    touch = touch.withColumn("site", site_from_url("url", "datetime_est", site_rules))
    attrs = visits.select("visit_id", *VISIT_ATTRIBUTES)
    return touch.join(attrs, "visit_id", "left").select(*FIRST_TOUCH_COLUMNS)


def latest_carts(carts: DataFrame) -> DataFrame:
    """W2+F3: the newest abandoned-cart line per (visitor IP, SKU).

    Ties on time are broken by the higher visit id.
    """
    return last_by(carts, ["visitor_ip", "item_sku"], ["datetime_est"], ["visit_id"]) \
        .select("visit_id", "visitor_ip", "item_sku")


def donor_carts(latest: DataFrame, touches: DataFrame,
                with_attributes: bool = False) -> DataFrame:
    """Latest carts with the landing URL of the cart's visit (NULL if none).

    With ``with_attributes`` the campaign attributes of the cart's visit come
    along too. They are the visit master's attributes for that visit (first
    touch already carries them, J1), which is what the repair needs (J6), so
    the visit master is not joined a second time.
    """
    cols = ["url", *VISIT_ATTRIBUTES] if with_attributes else ["url"]
    t = touches.select("visit_id", *cols)
    return latest.join(t, "visit_id", "left")
