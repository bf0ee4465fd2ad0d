"""Stand-in input views over the generated test tables.

The production inputs (visit logs, visit master, carts, goals, orders, profit
report, ad statistics, catalog maps, the two marts read by the SKU job) do not
exist in the test data. These views derive each of them from the generated
``events``, ``orders`` and ``part`` tables. The text is portable: it runs
unchanged in Spark SQL and in DuckDB, so the engine under test and the
independent oracle read identical inputs. ``{name}`` marks a reference to a
base table or to an earlier view.
"""

from __future__ import annotations

import re

from visitlens.contract import MART_TYPES, MASTER_RENAMES, master_columns
from visitlens.operators.sales import PROFIT_COLUMNS

# view name -> SQL text, in dependency order
VIEWS: dict[str, str] = {
    "web": """
select event_id, ts as datetime_est, user_id*100 + day(ts) as visit_id,
  '10.0.0.' || cast(user_id % 40 as string) as visitor_ip, event_type, value, k,
  'sku-' || cast(k % 20 as string) as item_sku,
  case when k % 3 = 0 then 69 when k % 3 = 1 then 71 when k = 50 then 67 else 12 end as site_id,
  case event_id % 12
   when 0 then 'https://www.shop.example/product/SKU-' || k || '-N/?utm_source=google&campaignid=' || (1000+k) || '&chid=4272'
   when 1 then 'https://www.shop.example/product/sku-' || k || '-r?cid=MMS' || k || '&adgroupid=' || (k*7)
   when 2 then 'https://www.shop.example/details/' || (k%5) || '-' || k || '/name?category_id=' || k
   when 3 then 'https://www.shop.example/details/' || k || '/name?catalogitemid=' || (k+500)
   when 4 then 'https://www.shop.example/product/sku-' || k || '/?product_id=P' || k || '&creative=' || k
   when 5 then 'https://www.shop.example/product/sku-' || k || '-bo'
   when 6 then 'https://www.shop.example/products/sku-' || k || '.jpg?targetid=pla-' || k || '&utm_cid=U' || k
   when 7 then 'https://www.shop.example/product/' || k || '?searchterm=abc'
   when 8 then 'https://www.shop.example/?kwd-' || k || '&adid=' || k || '&dat-1'
   when 9 then 'https://www.shop.example/product/sku-' || k || 'onerror=%20'
   when 10 then 'https://www.shop.example/product/sku-' || k || 'â€' || chr(141) || '-n/'
   else 'https://m.shop.example/account?cjevent=1&mms_chref=cj' end as url
from (select *, cast(regexp_extract(props,'([0-9]+)',1) as int) as k from {events}) e
""",
    "visit_events": """
select datetime_est, visitor_ip, visit_id, url from {web} where event_type in ('view','error')
""",
    "visit_actions": """
select datetime_est, visitor_ip, visit_id, url, site_id from {web} where event_type in ('view','click')
""",
    "visits": """
select visit_id, min(visitor_ip) as visitor_ip, min(site_id) as site_id, count(*) as actions,
  min(datetime_est) as first_action_datetime_est, cast(min(datetime_est) as date) as first_action_date_est,
  case visit_id % 9 when 0 then 'Google PLA' when 1 then 'google' when 2 then 'bingpla' when 3 then 'google text models'
    when 4 then 'bing text general' when 5 then 'mailmodo' when 6 then 'facebook' when 7 then 'google display' end as campaign_source,
  case visit_id % 3 when 0 then 'cpc' when 1 then 'text' end as campaign_medium,
  case visit_id % 5 when 0 then 'google' when 1 then 'bing' when 2 then 'facebook' end as ad_provider_id,
  case visit_id % 4 when 0 then 'campaign' when 1 then 'direct' when 2 then 'search' end as referrer_type,
  case visit_id % 7 when 0 then 'pinterest' when 1 then 'facebook' end as referrer_name{more_master}
from {web} group by visit_id
""",
    "carts": """
select datetime_est, visit_id, visitor_ip, upper(item_sku) as item_sku from {web} where event_type = 'error'
""",
    "goals": """
select visit_id from {web} where event_type = 'purchase'
""",
    "order_items": """
select visit_id, item_sku from {web} where event_type = 'purchase'
""",
    "visit_orders": """
select datetime_est, case when event_id % 13 <> 5 then visit_id end as visit_id,
  case when event_id % 7 = 0 then 'web-' || visit_id else 'web-' || visit_id || '-' || event_id end as order_id
from {web} where event_type = 'purchase'
""",
    "profit_loss": """
select cast(o_orderkey as string) as order_id, date '2024-01-31' - cast(o_orderkey % 60 as int) as order_created_date,
  case o_orderstatus when 'F' then 'PAID' when 'O' then 'AUTHORIZED' else 'PENDING' end as order_payment_status,
  case when o_orderpriority = '5-LOW' then 'Cancelled' else 'Shipped' end as order_status,
  o_totalprice as demand_revenue,
  case when o_orderstatus = 'F' then o_totalprice else cast(0 as double) end as net_revenue,
  case when o_orderkey % 4 = 0 then cast(null as double) else cast(1.5 as double) end as return_revenue,
  case when o_orderpriority = '5-LOW' then o_totalprice else cast(0 as double) end as cancelled_revenue,
  o_totalprice * cast(0.125 as double) as demand_profit,
  case o_orderkey % 9 when 0 then '' when 1 then 'c' end as cancelled_order_id{more_profit}
from {orders}
""",
    "ads_hourly": """
select case when k % 3 = 2 then 'Legacy' else 'NextGen' end as site, datetime_est as date, url as ad_final_url,
  cast(k as bigint) as impressions from {web} where event_type in ('view','click')
""",
    "pla_hourly": """
select case when k % 3 = 2 then 'Legacy' else 'NextGen' end as site, datetime_est as date,
  case when k % 3 = 2 then cast(k as string) else 'NG' || k end as product_item_id,
  cast(k as bigint) as impressions from {web} where event_type = 'click'
""",
    "container_items": """
select p_partkey - p_partkey % 2 as container_id, 500 + p_partkey as catalog_item_id from {part} where p_partkey % 7 <> 3
""",
    "sku_map": """
select 500 + p_partkey as catalog_item_id, 'SKU-' || p_partkey as akeneo_sku from {part} where p_partkey % 6 <> 5
""",
    "campaigns": """
select p_partkey as campaignid, 500 + p_partkey as catalogitemid from {part} where p_partkey % 3 <> 1
""",
    "products": """
select cast(p_partkey as string) as brightpearl_id, 'SKU-' || p_partkey as akeneo_sku from {part} where p_partkey % 5 <> 4
""",
    "order_facts_base": """
select v.datetime_est as date_est, v.visit_id, p.order_id, p.net_revenue, p.return_revenue, p.cancelled_revenue, p.demand_profit,
  case when order_payment_status = 'PAID' then false when order_payment_status = 'AUTHORIZED' and order_status = 'Cancelled' then true end as is_order_cancelled
from {visit_orders} v join {profit_loss} p on split_part(v.order_id, '-', 3) = p.order_id
""",
    "visit_mart": """
select * from {order_facts_base}
""",
    "visit_mart_legacy": """
select date_est, visit_id, order_id, is_order_cancelled, net_revenue + return_revenue + cancelled_revenue as revenue,
  demand_profit as profit from {order_facts_base} where visit_id % 2 = 0
""",
}



def _more(columns: list[str], view: str, key: str) -> str:
    """The contract's further columns of a view, with values that follow its key."""
    def value(i: int, c: str) -> str:
        kind = MART_TYPES.get(MASTER_RENAMES.get(c, c), "string")
        if kind == "double":
            return f"cast({key} % {i + 7} as double)"
        if kind == "timestamp_ntz":
            return "max(datetime_est)"
        return f"cast({key} % {i + 7} as int)" if kind in ("int", "bigint") else (
            f"'{c}-' || cast({key} % {i + 7} as string)")

    own = [c for c in columns if not re.search(rf"\b(as )?{c}\b", view)]
    return "".join(f",\n  {value(i, c)} as {c}" for i, c in enumerate(own))


VIEWS["visits"] = VIEWS["visits"].replace(
    "{more_master}", _more(master_columns(), VIEWS["visits"], "visit_id"))
VIEWS["profit_loss"] = VIEWS["profit_loss"].replace(
    "{more_profit}", _more(PROFIT_COLUMNS, VIEWS["profit_loss"], "o_orderkey"))

BASE_TABLES = ("events", "orders", "part")


def dependencies(name: str) -> list[str]:
    """Names referenced by a view (``{x}`` placeholders)."""
    return re.findall(r"\{(\w+)\}", VIEWS[name])


def closure(names) -> list[str]:
    """Views needed for ``names``, in dependency order (base tables excluded)."""
    out: list[str] = []

    def visit(n):
        if n in BASE_TABLES or n in out:
            return
        for d in dependencies(n):
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out
