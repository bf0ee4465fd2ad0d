"""Marketing channel resolution.

The channel rules are data: an ordered list of ``(condition, channel id)``
pairs folded into one ``CASE WHEN`` chain. The first matching rule wins; a
channel id taken from the URL overrides all rules unless it is NULL or empty.
Channel ids are strings throughout (the original mixes in one integer, which
under ANSI mode would turn the column numeric).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitlens.config import ChannelRules
from visitlens.functions.urls import _col


def channel_rule_list(source, medium, provider, referrer_type, referrer_name, url,
                      utm_source, rules: ChannelRules = ChannelRules()) -> list[tuple[Column, str]]:
    src = F.lower(_col(source))
    med = F.lower(_col(medium))
    prov = F.lower(_col(provider))
    u = _col(url)
    paid = lambda p, m: (prov == F.lit(p)) & (med == F.lit(m))
    return [
        (src.isin(*rules.google_pla_sources), "4272"),
        (((src == F.lit("google")) & u.like("%pla-%")) | paid("google", "cpc"), "4272"),
        (src.isin(*rules.bing_pla_sources), "4282"),
        (((src == F.lit("bing")) & u.like("%pla-%")) | paid("bing", "cpc"), "4282"),
        (src.isin(*rules.google_text_sources) | paid("google", "text"), "1"),
        (src.isin(*rules.bing_text_sources) | paid("bing", "text"), "1600"),
        ((F.coalesce(_col(source), _col(utm_source)) == F.lit(rules.mailmodo_exact))
         | src.isin(*rules.mailmodo_sources), "4"),
        (src.isin(*rules.facebook_sources)
         | (F.lower(_col(referrer_name)) == F.lit("facebook"))
         | (prov == F.lit("facebook")), "4292"),
        (F.lower(u).rlike(rules.affiliate_url_pattern), "2100"),
        (F.lower(_col(referrer_name)) == F.lit("pinterest"), "4275"),
        (F.lower(_col(referrer_type)) == F.lit("direct"), "0"),
    ]


def first_match(rules: list[tuple[Column, str]]) -> Column:
    """Fold ordered ``(condition, value)`` pairs into a CASE chain (else NULL)."""
    expr = None
    for cond, value in rules:
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(F.lit(None).cast("string"))


def channel_id(url_channel_id, source, medium, provider, referrer_type, referrer_name,
               url, utm_source, rules: ChannelRules = ChannelRules()) -> Column:
    """URL channel id if present and non-empty, else the first matching rule."""
    ucid = _col(url_channel_id)
    resolved = first_match(channel_rule_list(source, medium, provider, referrer_type,
                                             referrer_name, url, utm_source, rules))
    return F.when(ucid.isNull() | (ucid == F.lit("")), resolved).otherwise(ucid)


def is_google_display_ad(source, rules: ChannelRules = ChannelRules()) -> Column:
    """P36."""
    return (F.when(F.lower(_col(source)) == F.lit(rules.google_display_source), F.lit(True))
            .otherwise(F.lit(False)))


def channel_label(channel, rules: ChannelRules = ChannelRules()) -> Column:
    """Label of a channel id, ``Unknown`` otherwise."""
    c = _col(channel)
    expr = None
    for cid, label in rules.labels:
        cond = c == F.lit(cid)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(rules.unknown_label))
