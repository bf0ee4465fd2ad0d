"""The columns of the visit mart: an output contract of fixed names."""

from __future__ import annotations

from visitlens.functions.params import PARAM_COLUMNS
from visitlens.operators.sales import PROFIT_COLUMNS, SALES_TAIL
from visitlens.operators.touch import VISIT_ATTRIBUTES

# Output contract: the mart's 138 columns, in order.
MART_COLUMNS = [
    "date_est", "visit_id", "url", "site", "campaign_id", "mms_campaign_id",
    "mms_channel_id", "channel", "adgroup_id", "keyword_id", "product_id", "creative_id",
    "is_dsa_ad", "is_google_display_ad", "demand_order_id",
    *PROFIT_COLUMNS, *SALES_TAIL,
    "site_id", "site_name", "sub_store_id", "store_id", "visitor_ip", "visitor_id",
    "first_action_datetime_utc", "first_action_datetime_est", "last_action_datetime_utc",
    "last_action_datetime_est", "fingerprint", "goal_conversions", "site_currency",
    "site_currency_symbol", "visit_server_hour", "user_id", "visitor_type",
    "visitor_type_icon", "visit_converted", "visit_converted_icon", "visit_count",
    "visit_ecommerce_status", "visit_ecommerce_status_icon", "days_since_first_visit",
    "seconds_since_first_visit", "days_since_last_ecommerce_order",
    "seconds_since_last_ecommerce_order", "visit_duration", "searches", "actions",
    "interactions", "referrer_type", "referrer_type_name", "referrer_name",
    "referrer_keyword", "referrer_keyword_position", "referrer_url",
    "referrer_search_engine_url", "referrer_search_engine_icon",
    "referrer_social_network_url", "referrer_social_network_icon", "language_code",
    "language", "device_type", "device_type_icon", "device_brand", "device_model",
    "operating_system", "operating_system_name", "operating_system_icon",
    "operating_system_code", "operating_system_version", "browser_family",
    "browser_family_description", "browser", "browser_name", "browser_icon",
    "browser_code", "browser_version", "total_ecommerce_revenue",
    "total_ecommerce_conversions", "total_ecommerce_items",
    "total_abandoned_carts_revenue", "total_abandoned_carts",
    "total_abandoned_carts_items", "events", "continent", "continent_code", "country",
    "country_code", "country_flag", "region", "region_code", "city", "location",
    "latitude", "longitude", "visit_local_time", "visit_local_hour",
    "days_since_last_visit", "seconds_since_last_visit", "resolution", "plugins",
    "ad_click_id", "ad_provider_id", "ad_provider_name", "ad_provider_icon",
    "form_conversions", "session_replay_url", "campaign_id_matomo", "campaign_content",
    "campaign_keyword", "campaign_medium", "campaign_name_matomo", "campaign_source",
    "campaign_group", "campaign_placement", "site_url", "first_action_timestamp",
    "last_action_timestamp", "first_action_date_est",
]

# visit-master columns renamed on the way into the mart (source -> mart name)
MASTER_RENAMES = {
    "visit_server_hour_utc": "visit_server_hour",
    "campaign_id": "campaign_id_matomo",
    "campaign_name": "campaign_name_matomo",
    "first_action_timestamp_utc": "first_action_timestamp",
    "last_action_timestamp_utc": "last_action_timestamp",
}
# mart columns that come from the (repaired) visit rows, not from the master
FROM_VISIT_ROWS = {"date_est", "visit_id", "url", "site", *PARAM_COLUMNS, "channel",
                   "is_google_display_ad", "demand_order_id", *PROFIT_COLUMNS,
                   *SALES_TAIL, *VISIT_ATTRIBUTES}
CONSTANTS = {"sub_store_id", "store_id", "site_url"}

# types of mart columns that are not strings, for columns a source lacks
MART_TYPES = {
    **dict.fromkeys(PROFIT_COLUMNS[3:15] + ["total_item_cost", "selling_price",
                                            "coupon_discount"], "double"),
    "cancel_orders": "int", "is_order_cancelled": "boolean",
    **dict.fromkeys(["site_id", "sub_store_id", "store_id", "visit_count", "visit_duration",
                     "searches", "actions", "interactions", "events"], "bigint"),
    **dict.fromkeys(["first_action_datetime_utc", "first_action_datetime_est",
                     "last_action_datetime_utc", "last_action_datetime_est"], "timestamp_ntz"),
    "first_action_date_est": "date",
}


def master_columns() -> list[str]:
    """The visit-master columns that the mart passes through, under their own names."""
    source = {mart: own for own, mart in MASTER_RENAMES.items()}
    return [source.get(c, c) for c in MART_COLUMNS if c not in FROM_VISIT_ROWS | CONSTANTS]
