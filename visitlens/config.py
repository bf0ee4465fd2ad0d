"""Parameters of the two marts.

Site ids, host names, store ids and channel codes of the original jobs are
business configuration, so they live here as parameters. The defaults are the
values the original jobs hard-code wherever they are plain codes (site ids,
channel ids, labels, suffix codes); host names default to neutral example hosts
that the test fixtures use.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# These must equal the original jobs' values for equal results.
# ---------------------------------------------------------------------------

# site labels written into the marts and read back by the SKU mart
NEXTGEN = "NextGen"
LEGACY = "Legacy"

# after the cutover a visit URL on the main host counts as the new site unless
# its path matches one of these (original regex, applied to the lower-cased URL)
NEXTGEN_EXCLUDED_PATHS = (
    "/cat/|/catnc/|/details/|/website|/shoppingcart|/package|/category|/account|/help"
)
# the original cutover between the two URL rules (inclusive upper bound of the
# first rule)
DEFAULT_SITE_CUTOVER = dt.date(2023, 6, 30)

# mis-decoded bytes of a UTF-8 zero-width joiner; each character is removed on
# its own from visit URLs before anything else: euro sign, U+008D, a-circumflex
MOJIBAKE_CHARS = ("€", "\u008d", "â")

# product-page tests on the lower-cased URL
AD_PRODUCT_PAGE = "(/details/|/product/)"
VISIT_PRODUCT_PAGE = "(/details/|/product/|/products/)"

# container-id test patterns (ads test without the leading slash)
AD_CONTAINER_TEST = "details/[0-9]+-[0-9]+/"
VISIT_CONTAINER_TEST = "/details/[0-9]+-[0-9]+/"

# SKU suffix handling. The original compares the *reversed* text after the last
# dash of the last path segment with these codes, then strips a one-letter
# suffix with the regex. Two-letter codes therefore never strip (see README).
AD_SUFFIX_CODES = ("n", "r", "u", "ob", "mr", "cr")
AD_SUFFIX_STRIP = "([^/]+)-[nruobmc]$"
VISIT_SUFFIX_CODES = ("n", "r")
VISIT_SUFFIX_STRIP = "([^/]+)-[nr]$"

# SKU-mart exclusions: on-site search pages, and garbage / exploit URLs tested
# on a group's representative URL
SEARCH_MARKER = "searchterm="
EXPLOIT_PATTERN = "(_exploit_dom_xss|onerror=|%20)"

# text removed from SKUs after grouping
SKU_STRIP_TEXT = "jpg"

# order status codes
PAID_STATUSES = ("PAID", "PARTIALLY_PAID")
AUTHORIZED_STATUS = "AUTHORIZED"
CANCELLED_ORDER_STATUSES = ("Cancelled", "Issue Refund")


@dataclass(frozen=True)
class SiteRules:
    """Classify a visit URL as the new or the legacy site.

    On or before ``cutover`` a URL is the new site when it starts with one of
    ``early_prefixes`` or contains one of ``early_hosts``; afterwards when it
    contains ``host`` and its path matches none of ``excluded_paths``.
    """

    cutover: dt.date = DEFAULT_SITE_CUTOVER
    early_prefixes: tuple[str, ...] = ("https://online.shop.example",)
    early_hosts: tuple[str, ...] = (".shoponline.example",)
    host: str = "www.shop.example"
    excluded_paths: str = NEXTGEN_EXCLUDED_PATHS


@dataclass(frozen=True)
class ChannelRules:
    """Ordered channel rules and channel labels (first match wins)."""

    # Campaign-source names per channel as the original lists them
    google_pla_sources: tuple[str, ...] = (
        "google pla", "google plautm_medium=cpc", "google?utm_medium=pla",
        "google p", "google%20pla")
    bing_pla_sources: tuple[str, ...] = ("bing pla", "bingpla", "bing plautm_medium=cpc")
    google_text_sources: tuple[str, ...] = (
        "google text accesory for", "google%20text%20general", "google%20text%20models",
        "google text models", "google text general", "google text generic",
        "google text accessory for", "google text accessory%for")
    bing_text_sources: tuple[str, ...] = (
        "bing text accessory for", "bing text general", "bing text generic",
        "bing text accessory%for", "bing text models")
    mailmodo_exact: str = "mailmodo"
    mailmodo_sources: tuple[str, ...] = ("mailmodo", "mailm", "3dmailmodo")
    facebook_sources: tuple[str, ...] = ("facebook", "social-fb", "facebookads")
    affiliate_url_pattern: str = "cjevent|mms_chref=cj"
    google_display_source: str = "google display"
    # Channel ids and labels, in the original order
    labels: tuple[tuple[str, str], ...] = (
        ("4", "Mailmodo"),
        ("1", "Google Text"),
        ("1600", "Bing Text"),
        ("4282", "Bing PLA"),
        ("4272", "Google PLA"),
        ("4274", "Google Remarketing"),
        ("4275", "Pinterest"),
        ("4292", "Facebook"),
        ("2100", "Commission Junction"),
        ("0", "Organic"),
    )
    unknown_label: str = "Unknown"


@dataclass(frozen=True)
class VisitMartConfig:
    as_of: dt.date
    site_rules: SiteRules   # no default: other hosts would label every visit wrong
    days: int = 45
    channel_rules: ChannelRules = field(default_factory=ChannelRules)
    store_id: int = 69
    # reproduce the original's dead shopping-ad fallback of product_id
    product_id_null_on_miss: bool = False
    # what to do with pass-through columns absent from the visits table:
    # "error" or "null" (typed as MART_TYPES says)
    missing_columns: str = "error"
    # compute first touch once and checkpoint it (it has three consumers)
    materialize_touches: bool = True
    # a visit with more orders in the window than this has them split over
    # several tasks in the final visits-sales join (exact at any value)
    sales_rows_per_task: int = 100_000
    # visits with a goal are sent to the first touches up to this number of them
    max_goal_visits: int = 5_000_000


@dataclass(frozen=True)
class SkuMartConfig:
    as_of: dt.date
    months: int = 4
    lag_days: int = 2
    sku_site_ids: tuple[int, ...] = (69, 71)
    excluded_site_ids: tuple[int, ...] = (67,)
    # U2 in the original is a distinct union; False keeps both equal rows
    dedupe_impressions: bool = True
    # dimension tables are broadcast only when they have at most this many
    # rows and bytes (checked by one small job per table)
    broadcast_max_rows: int = 2_000_000
    broadcast_max_bytes: int = 256 * 1024 * 1024
