"""URL column functions.

All functions take and return :class:`pyspark.sql.Column` and are built from
native Spark functions only, so they compile into whole-stage codegen.

NULL versus empty string: the SQL dialect of the SKU job returns NULL when a
regex does not match or a split part is missing, and its logic relies on it
(coalesce fallbacks, ``is not null`` filters). Spark returns ``''``.
:func:`extract_or_null` restores the NULL; it is exact because every pattern
group used here ends in ``+``, so a real match is never empty.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitlens import config as C


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_or_null(s, pattern: str, group: int = 1) -> Column:
    """``regexp_extract`` that yields NULL instead of ``''`` when nothing matches."""
    return F.nullif(F.regexp_extract(_col(s), pattern, group), F.lit(""))


# --- canonical forms ------------------------------------------------------

def url_path(url) -> Column:
    """Lower-cased URL without its query string."""
    return F.substring_index(F.lower(_col(url)), "?", 1)


def clean_url(url) -> Column:
    """Drop the mojibake characters one by one, lower-case, drop the query."""
    removed = _col(url)
    for ch in C.MOJIBAKE_CHARS:
        removed = F.replace(removed, F.lit(ch), F.lit(""))
    return F.substring_index(F.lower(removed), "?", 1)


def last_segment(path) -> Column:
    """Text after the last ``/`` ('' for a trailing slash)."""
    return F.substring_index(_col(path), "/", -1)


# --- site -----------------------------------------------------------------

def site_from_url(url, ts, rules: C.SiteRules = C.SiteRules()) -> Column:
    """New vs legacy site from the URL, with a rule switch at ``rules.cutover``."""
    u = F.lower(_col(url))
    early = F.lit(False)
    for prefix in rules.early_prefixes:
        early = early | u.startswith(prefix.lower())
    for host in rules.early_hosts:
        early = early | u.contains(host.lower())
    late = u.contains(rules.host.lower()) & ~u.rlike(rules.excluded_paths)
    label = lambda cond: F.when(cond, F.lit(C.NEXTGEN)).otherwise(F.lit(C.LEGACY))
    return (F.when(F.to_date(_col(ts)) <= F.lit(rules.cutover), label(early))
            .otherwise(label(late)))


def site_from_id(site_id, ids=(69, 71)) -> Column:
    """New site when ``site_id`` is one of ``ids`` (NULL counts as legacy)."""
    return F.when(_col(site_id).isin(*ids), F.lit(C.NEXTGEN)).otherwise(F.lit(C.LEGACY))


# --- product keys ----------------------------------------------------------

def is_product_page(url, pattern: str = C.AD_PRODUCT_PAGE) -> Column:
    """product-page URL test on the lower-cased URL."""
    return F.lower(_col(url)).rlike(pattern)


def not_search(url) -> Column:
    """exclude on-site search result URLs."""
    return ~F.lower(_col(url)).contains(C.SEARCH_MARKER)


def not_exploit(url) -> Column:
    """exclude garbage / exploit URLs."""
    return ~F.lower(_col(url)).rlike(C.EXPLOIT_PATTERN)


def container_id(path, test: str = C.AD_CONTAINER_TEST) -> Column:
    """``details/N-M/`` gives M, otherwise ``details/N`` gives N."""
    p = _col(path)
    return (F.when(p.rlike(test), extract_or_null(p, "/details/([0-9]+)-([0-9]+)/", 2))
            .otherwise(extract_or_null(p, "details/([0-9]+)", 1)))


def container_join_key(path) -> Column:
    """The join/group variant - M only when N is exactly ``0``."""
    p = _col(path)
    first = extract_or_null(p, "details/([0-9]+)", 1)
    return (F.when(first == F.lit("0"), extract_or_null(p, "/details/([0-9]+)-([0-9]+)/", 2))
            .otherwise(first))


def category_id(url) -> Column:
    """``category_id=<digits>`` from the lower-cased URL."""
    return extract_or_null(F.lower(_col(url)), "category_id=([0-9]+)", 1)


def catalog_item_id(url) -> Column:
    """``catalogitemid=<digits>`` from the lower-cased URL."""
    return extract_or_null(F.lower(_col(url)), "catalogitemid=([0-9]+)", 1)


def sku_from_path(path, codes=C.AD_SUFFIX_CODES, strip: str = C.AD_SUFFIX_STRIP) -> Column:
    """SKU from the last path segment of a canonical URL path.

    The segment is the text after the last ``/``, or the one before a trailing
    slash. When the reversed text after its last dash is one of ``codes`` the
    one-letter suffix is stripped with ``strip`` (NULL if that regex does not
    match); otherwise the segment itself is the SKU (NULL if empty).
    """
    p = _col(path)
    last = F.substring_index(p, "/", -1)
    segment = F.when(last == F.lit(""),
                     F.substring_index(F.substring_index(p, "/", -2), "/", 1)).otherwise(last)
    suffix_reversed = F.reverse(F.substring_index(segment, "-", -1))
    return (F.when(suffix_reversed.isin(*codes), extract_or_null(segment, strip, 1))
            .otherwise(F.nullif(segment, F.lit(""))))


def ad_sku(site, path) -> Column:
    """SKU of an ad URL, only for the new site."""
    return F.when(_col(site) == F.lit(C.NEXTGEN),
                  sku_from_path(path, C.AD_SUFFIX_CODES, C.AD_SUFFIX_STRIP))


def visit_sku(site_id, clean, ids=(69, 71)) -> Column:
    """SKU of a visited URL, only for the SKU-bearing site ids.

    (The original also lists upper-case ``N``/``R`` for one branch; the path is
    lower-cased by then, so they can never match.)
    """
    return F.when(_col(site_id).isin(*ids),
                  sku_from_path(clean, C.VISIT_SUFFIX_CODES, C.VISIT_SUFFIX_STRIP))


def product_identifier(site_id, clean, ids=(69, 71)) -> Column:
    """Last path segment for the other sites (NULL site id gives NULL)."""
    return F.when(~_col(site_id).isin(*ids), last_segment(clean))


def ng_product_id(item_id) -> Column:
    """``ng<digits>`` shopping-ad item id -> digits (NULL when absent)."""
    return extract_or_null(F.lower(_col(item_id)), "ng([0-9]+)", 1)


def pla_product_id(item_id, site) -> Column:
    """Numeric product id of a shopping-ad item, only for the new site."""
    return F.when(_col(site) == F.lit(C.NEXTGEN), ng_product_id(item_id))


def strip_sku_text(sku) -> Column:
    """Remove the literal ``jpg`` from a SKU (``x.jpg`` -> ``x.``)."""
    return F.replace(_col(sku), F.lit(C.SKU_STRIP_TEXT), F.lit(""))
