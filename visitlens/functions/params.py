"""Campaign parameters from landing URLs.

The original writes most patterns with a look-behind, e.g.
``(?<=cid|utm_cid|product_id)=?(...)``. A look-behind match starting right after
the keyword finds the same text as the plain pattern ``(?:keyword)=?(...)`` with
the value as group 1, because no keyword ends inside another one at a different
position. The plain form is used so the same pattern also runs in engines
without look-behind, and a pattern starting with a literal keyword lets the
regex engine skip ahead to it (about 2.5x faster than the look-behind).
Matching is by substring and case-sensitive (``placid`` matches ``cid``); the
URL is not lower-cased. No match yields ``''`` (Spark).
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitlens.functions.urls import _col, extract_or_null

# Parameter patterns (value in group 1 unless said otherwise)
CAMPAIGN_ID = "campaignid=?([0-9]+)"
MMS_CAMPAIGN_ID = "(?:cid|utm_cid|product_id)=?([A-Za-z0-9]+)"
UTM_SOURCE = "(utm_source=([a-z]+))"          # value in group 2
MMS_CHANNEL_ID = "chid=?([0-9]+)"
ADGROUP_ID = "adgroupid=?([0-9]+)"
KEYWORD_ID = "(kwd\\-([0-9]+))"                # value in group 2
PRODUCT_ID = "product_id=?([A-Za-z0-9]+)"
SHOPPING_CID = "(?:cid|utm_cid)=?([A-Za-z0-9]+)"
SHOPPING_MARKERS = ("%adtype=pla%", "%targetid=pla-%")
CREATIVE_ID = "(?:creative|adid)=?([0-9]+)"
DSA_MARKERS = ("%dsa-%", "%dat-%")


def campaign_id(url) -> Column:
    return F.regexp_extract(_col(url), CAMPAIGN_ID, 1)


def mms_campaign_id(url) -> Column:
    return F.regexp_extract(_col(url), MMS_CAMPAIGN_ID, 1)


def utm_source(url) -> Column:
    return F.regexp_extract(_col(url), UTM_SOURCE, 2)


def mms_channel_id(url) -> Column:
    return F.regexp_extract(_col(url), MMS_CHANNEL_ID, 1)


def adgroup_id(url) -> Column:
    return F.regexp_extract(_col(url), ADGROUP_ID, 1)


def keyword_id(url) -> Column:
    return F.regexp_extract(_col(url), KEYWORD_ID, 2)


def product_id(url, null_on_miss: bool = False) -> Column:
    """``product_id`` value, lower-cased, with a shopping-ad fallback.

    With ``null_on_miss=False`` (the original behaviour) a URL without
    ``product_id`` gives ``''`` and the fallback is never reached.
    """
    u = _col(url)
    primary = (extract_or_null(u, PRODUCT_ID, 1) if null_on_miss
               else F.regexp_extract(u, PRODUCT_ID, 1))
    shopping = u.like(SHOPPING_MARKERS[0])
    for m in SHOPPING_MARKERS[1:]:
        shopping = shopping | u.like(m)
    fallback = F.when(shopping, F.regexp_extract(u, SHOPPING_CID, 1))
    return F.lower(F.coalesce(primary, fallback))


def creative_id(url) -> Column:
    return F.regexp_extract(_col(url), CREATIVE_ID, 1)


def is_dsa_ad(url) -> Column:
    """Dynamic-search ad marker in the URL; NULL URL gives false."""
    u = F.lower(_col(url))
    cond = u.like(DSA_MARKERS[0])
    for m in DSA_MARKERS[1:]:
        cond = cond | u.like(m)
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


PARAM_COLUMNS = ("campaign_id", "mms_campaign_id", "utm_source", "mms_channel_id",
                 "adgroup_id", "keyword_id", "product_id", "creative_id", "is_dsa_ad")


def url_param_columns(url: str = "url", null_on_miss: bool = False) -> list[Column]:
    """All nine parameter columns of the column named ``url``, aliased, in the mart's order."""
    return list(_param_columns(url, null_on_miss))


@lru_cache(maxsize=32)
def _param_columns(url: str, null_on_miss: bool) -> tuple[Column, ...]:
    # built once per (column, flag): the expressions are unresolved and reusable
    return (
        campaign_id(url).alias("campaign_id"),
        mms_campaign_id(url).alias("mms_campaign_id"),
        utm_source(url).alias("utm_source"),
        mms_channel_id(url).alias("mms_channel_id"),
        adgroup_id(url).alias("adgroup_id"),
        keyword_id(url).alias("keyword_id"),
        product_id(url, null_on_miss).alias("product_id"),
        creative_id(url).alias("creative_id"),
        is_dsa_ad(url).alias("is_dsa_ad"),
    )
