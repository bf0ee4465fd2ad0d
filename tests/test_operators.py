
import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from visitlens.config import SiteRules, SkuMartConfig
from visitlens.functions import exact
from visitlens.operators import touch
from visitlens.operators.impressions import impressions_by_sku
from visitlens.operators.joins import broadcast_if_bounded, has_at_most, left_join_nullable_key
from visitlens.operators.pages import (MONEY_MEASURES, money_as_double, order_facts_union,
                                       page_facts, page_facts_by_item)
from visitlens.operators.repair import apply_repair, attribution_repair
from visitlens.plans.sku_mart import sku_totals
from visitlens.session import session_conf

CFG = SkuMartConfig(as_of=dt.date(2024, 5, 17))
TS = dt.datetime(2024, 3, 1, 10)


def test_impressions_distinct_union(spark):
    text = spark.createDataFrame([("K", 5), ("a", 1)], "akeneo_sku string, impressions long")
    pla = spark.createDataFrame([("K", 5), ("A", 2)], "akeneo_sku string, impressions long")
    assert sorted(rows(impressions_by_sku(text, pla))) == [("a", 3), ("k", 5)]
    assert sorted(rows(impressions_by_sku(text, pla, dedupe=False))) == [("a", 3), ("k", 10)]


def _actions(spark, data):
    return spark.createDataFrame(data, "datetime_est timestamp_ntz, visitor_ip string, "
                                       "visit_id long, url string, site_id int")


def _facts(spark, data):
    return spark.createDataFrame(data, "visit_id long, order_id string, "
                                       "is_order_cancelled boolean, revenue double, profit double")


def test_any_view_attribution_counts(spark):
    url = "https://h/product/sku-1"
    actions = _actions(spark, [(TS, "ip", 1, url, 69), (TS, "ip", 1, url, 69)])
    facts = _facts(spark, [(1, "o1", False, 100.0, 10.0)])
    pages = page_facts(actions, facts, CFG)
    assert rows(money_as_double(pages), "net_orders", "net_revenue", "cancel_orders", "cancel_revenue") == [
        (2, 200, 0, None)]
    items = page_facts_by_item(pages, spark.createDataFrame([], "container_id long, "
                                                                "catalog_item_id long"), CFG)
    assert rows(money_as_double(items), "akeneo_sku", "pageviews", "net_orders", "net_revenue") == [
        ("sku-1", 1, 2, 200)]


def test_page_facts_filters(spark):
    actions = _actions(spark, [
        (TS, "ip", 1, "https://h/product/a?searchterm=x", 69),   # search page
        (TS, "ip", 1, "https://h/product/b", 67),                # excluded site
        (TS, "ip", 1, "https://h/product/c", None),              # null site id
        (TS, "ip", 1, "https://h/cart", 69),                     # not a product page
        (dt.datetime(2023, 12, 1), "ip", 1, "https://h/product/d", 69),  # outside window
        (TS, "ip", 1, "https://h/products/e", 12),               # kept, legacy site
    ])
    pages = page_facts(actions, _facts(spark, []), CFG)
    assert rows(pages, "url", "site", "akeneo_sku", "product_identifier", "net_orders") == [
        ("https://h/products/e", "Legacy", None, "e", 0)]


def test_revenue_null_propagates(spark):
    current = spark.createDataFrame(
        [(TS, 1, "o1", 10.0, None, 2.0, 1.0, False), (TS, 2, "o2", 10.0, 1.0, 2.0, 1.0, True)],
        "date_est timestamp_ntz, visit_id long, order_id string, net_revenue double, "
        "return_revenue double, cancelled_revenue double, demand_profit double, "
        "is_order_cancelled boolean")
    legacy = _facts(spark, [(2, "o2", True, 13.0, 1.0)]).withColumn("date_est", F.lit(TS))
    out = order_facts_union(legacy, current, CFG)
    # the legacy row equals the current one for visit 2 and collapses (distinct)
    assert sorted(rows(out, "visit_id", "revenue")) == [(1, None), (2, 13.0)]


def _items(spark, data):
    df = spark.createDataFrame(
        data, "eurl string, catalog_item_id string, akeneo_sku string, pageviews long, "
              "net_orders long, cancel_orders long, net_revenue double, "
              "cancel_revenue double, profit double")
    df = df.withColumns({f"h{c}": exact.held(c) for c in MONEY_MEASURES})
    return df.withColumns({c: exact.exact(c, f"h{c}") for c in MONEY_MEASURES})


def test_sku_totals_fill_zero_and_exploit(spark):
    items = _items(spark, [
        ("https://h/product/sku-1", None, "SKU-1", 3, 0, 0, None, None, None),
        ("https://h/product/sku-2onerror=", None, "sku-2", 5, 1, 0, 9.0, None, 1.0),
    ])
    sku_map = spark.createDataFrame([], "catalog_item_id long, akeneo_sku string")
    products = spark.createDataFrame([("SKU-1",), ("sku-2",)], "akeneo_sku string")
    imps = spark.createDataFrame([], "akeneo_sku string, impressions long")
    out = sku_totals(items, sku_map, products, imps, CFG)
    assert rows(out) == [("sku-1", 3, 0, 0, 0.0, 0.0, 0.0, 0)]
    assert all(v is not None for r in rows(out) for v in r)


def test_first_and_last_by_one_row_per_key(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 2), "b", "ip1"), (1, dt.datetime(2024, 1, 1), "z", "ip2"),
         (1, dt.datetime(2024, 1, 1), "a", "ip3"), (2, None, "q", "ip"), (2, dt.datetime(2024, 1, 5), "r", "ip")],
        "visit_id long, datetime_est timestamp_ntz, url string, visitor_ip string")
    first = touch.first_by(df, ["visit_id"], ["datetime_est"], ["url", "visitor_ip"])
    assert sorted(rows(first, "visit_id", "url")) == [(1, "a"), (2, "q")]   # NULL time sorts first
    last = touch.last_by(df, ["visit_id"], ["datetime_est"], ["url"])
    assert sorted(rows(last, "visit_id", "url")) == [(1, "b"), (2, "r")]    # NULL time sorts last


def test_union_logs_has_no_duplicates(spark):
    ev = _actions(spark, [(TS, "ip", 1, "u", 1), (TS, "ip", 1, "u", 1)]).drop("site_id")
    out = touch.union_logs(ev, ev, dt.date(2024, 3, 5), 14)
    assert out.count() == 1


def _touch_rows(spark, data):
    return spark.createDataFrame(data, "datetime_est timestamp_ntz, visitor_ip string, "
                                       "visit_id long, url string, site string, "
                                       "campaign_source string, campaign_medium string, "
                                       "ad_provider_id string, referrer_type string, "
                                       "referrer_name string")


def test_repair_rules(spark):
    touches = _touch_rows(spark, [
        (TS, "ip1", 1, "https://h/p", "x", None, None, None, "direct", None),   # buyer
        (TS, "ip1", 2, "https://h/p", "x", None, None, None, None, None),       # NULL referrer
        (TS, "ip1", 9, "https://h/land?utm=x", "x", "google", "cpc", None, "campaign", None),
        (TS, "ip2", 3, "https://h/p", "x", None, None, None, "search", None),   # mixed-case SKU
    ])
    goals = spark.createDataFrame([(1,), (1,), (2,), (3,)], "visit_id long")
    items = spark.createDataFrame([(1, "abc"), (2, "abc"), (3, "ABC")], "visit_id long, item_sku string")
    carts = spark.createDataFrame([(TS, 9, "ip1", "ABC"), (TS, 8, "ip2", "abc")],
                                  "datetime_est timestamp_ntz, visit_id long, visitor_ip string, item_sku string")
    donors = touch.donor_carts(touch.latest_carts(carts), touches, with_attributes=True)
    repairs = attribution_repair(touches, goals, items, donors)
    # only visit 1 is repaired: visit 2 has a NULL referrer type, visit 3 orders
    # upper-case 'ABC' which never equals a lower-cased cart SKU
    assert rows(repairs, "visit_id", "url", "campaign_source") == [(1, "https://h/land?utm=x", "google")]
    fixed = apply_repair(touches, repairs)
    got = {r["visit_id"]: (r["url"], r["campaign_source"]) for r in fixed.collect()}
    assert got[1] == ("https://h/land?utm=x", "google") and got[2] == ("https://h/p", None)


def test_left_join_nullable_key_keeps_null_rows(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "k string, v int")
    right = spark.createDataFrame([("a", 10), ("b", 20)], "rk string, w int")
    out = left_join_nullable_key(left, right, "k", "rk")
    assert sorted(rows(out, "v", "w"), key=str) == [(1, 10), (2, None), (3, None)]


def test_broadcast_only_when_bounded(spark):
    small = spark.range(10)
    assert has_at_most(small, 10) and not has_at_most(small, 9)
    wide = spark.createDataFrame([("x" * 1000,)] * 5, "s string")
    assert has_at_most(wide, 10) and not has_at_most(wide, 10, max_bytes=4000)
    assert broadcast_if_bounded(wide, 10, max_bytes=4000) is wide     # unhinted beyond the bound
    plan = small.join(broadcast_if_bounded(spark.range(5), 5), "id")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_full_width_mart_contract(spark):
    """With a complete visit master the mart has the 138 columns in order,
    master columns renamed, constants filled, attributes from the visit rows."""
    import dataclasses

    from visitlens.config import VisitMartConfig
    from visitlens.plans import visit_mart as vm

    inverse = {v: k for k, v in vm.MASTER_RENAMES.items()}
    master_cols = [inverse.get(c, c) for c in vm.MART_COLUMNS
                   if c not in vm.FROM_VISIT_ROWS and c not in vm.CONSTANTS]
    master_cols += ["visit_id", "campaign_source"]          # source-side attribute, not used
    row = {c: f"m_{c}" for c in master_cols}
    row.update(visit_id=1, first_action_datetime_est=TS, first_action_date_est=TS.date(),
               campaign_source="from master")
    visits = spark.createDataFrame([tuple(row[c] for c in master_cols)],
                                   ", ".join(f"`{c}` {_type(c)}" for c in master_cols))
    f_data = spark.createDataFrame(
        [(1, "ip", TS, "NextGen", "https://h/?chid=4272", "", "", "", "4272", "", "", "", "", False,
          "google", "cpc", None, "direct", None)],
        "visit_id long, visitor_ip string, datetime_est timestamp_ntz, site string, url string, "
        "campaign_id string, mms_campaign_id string, utm_source string, mms_channel_id string, "
        "adgroup_id string, keyword_id string, product_id string, creative_id string, "
        "is_dsa_ad boolean, campaign_source string, campaign_medium string, "
        "ad_provider_id string, referrer_type string, referrer_name string")
    sales = spark.createDataFrame([(TS, 1, "9", "9", 1, True)],
                                  "report_datetime timestamp_ntz, visit_id long, "
                                  "demand_order_id string, order_id string, cancel_orders int, "
                                  "is_order_cancelled boolean")
    cfg = VisitMartConfig(as_of=dt.date(2024, 3, 5), site_rules=SiteRules(),
                          missing_columns="null")
    mart = vm.attach_to_visits(visits, f_data, sales).transform(vm.with_channel, cfg) \
        .transform(vm.project_mart, cfg)
    assert mart.columns == vm.MART_COLUMNS and len(mart.columns) == 138
    r = mart.first()
    assert r["campaign_source"] == "google"                       # from the visit rows
    assert r["campaign_id_matomo"] == "m_campaign_id"             # renamed master column
    assert r["visit_server_hour"] == "m_visit_server_hour_utc"
    assert (r["sub_store_id"], r["store_id"], r["site_url"]) == (69, 69, "")
    assert (r["mms_channel_id"], r["channel"], r["order_id"]) == ("4272", "Google PLA", "9")
    assert r["net_revenue"] is None                               # absent from this profit report


def _type(c):
    return {"visit_id": "long", "first_action_datetime_est": "timestamp_ntz",
            "first_action_date_est": "date"}.get(c, "string")


def test_page_facts_equal_fanout_join_on_random_data(spark):
    """The pair-free page facts equal the original's fan-out join + grouping."""
    import random

    import pandas as pd

    rnd = random.Random(3)
    urls = [f"https://h/product/sku-{i}" for i in range(6)]
    actions = [(TS, "ip", 0 if rnd.random() < 0.4 else rnd.randint(1, 30), rnd.choice(urls),
                rnd.choice([69, 71, 12])) for _ in range(600)]        # visit 0 is hot
    facts = [(rnd.randint(0, 30), rnd.choice([f"o{j}" for j in range(40)] + [None]),
              rnd.choice([True, False, None]), rnd.choice([None, 1.25, 10.5, 99.99]),
              rnd.choice([None, 0.5, 3.0])) for _ in range(120)]
    got = money_as_double(page_facts(_actions(spark, actions), _facts(spark, facts), CFG)).toPandas()

    a = pd.DataFrame(actions, columns=["ts", "ip", "visit_id", "url", "site_id"])
    f = pd.DataFrame(facts, columns=["visit_id", "order_id", "cancelled", "revenue", "profit"])
    j = a.merge(f, on="visit_id", how="left")
    j["site"] = j.site_id.isin([69, 71]).map({True: "NextGen", False: "Legacy"})
    canc, kept = j.cancelled.eq(True), j.cancelled.eq(False)
    j["c_ord"] = j.order_id.where(canc).notna()
    j["n_ord"] = j.order_id.where(kept).notna()
    j["c_rev"], j["n_rev"] = j.revenue.where(canc), j.revenue.where(kept)
    want = j.groupby(["visit_id", "url", "site"]).agg(
        cancel_orders=("c_ord", "sum"), net_orders=("n_ord", "sum"),
        cancel_revenue=("c_rev", lambda s: s.sum(min_count=1)),
        net_revenue=("n_rev", lambda s: s.sum(min_count=1)),
        profit=("profit", lambda s: s.sum(min_count=1))).reset_index()

    def norm(df):
        rows = []
        for r in df.itertuples(index=False):
            rows.append((int(r.visit_id), r.url, r.site, int(r.cancel_orders), int(r.net_orders),
                         *[None if pd.isna(v) else round(float(v), 6)
                           for v in (r.cancel_revenue, r.net_revenue, r.profit)]))
        return sorted(rows, key=str)

    assert norm(got[want.columns]) == norm(want)


def test_splitting_large_keys_is_exact(spark):
    """Right rows mostly without a key, one large key, one left row without match."""
    from visitlens.operators.joins import SplitKeys

    left = spark.createDataFrame([(1, "a"), (1, "a2"), (2, "b"), (3, "c"), (None, "n")],
                                 "k long, l string")
    right = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 7)]
                                  + [(None, i) for i in range(60)], "rk long, r int")
    plain = left.join(right, left.k == right.rk, "left")
    assert plain.count() == 103
    for rows_per_task in (1, 7, 30, 1000):
        keys = SplitKeys(right.select("rk"), rows_per_task)
        assert keys.any == (rows_per_task < 50)
        copies = keys.copied(left, "k", "b", "s")
        dealt = keys.dealt(right.where("rk IS NOT NULL"), "rk", "rb")
        split = copies.join(dealt, (copies.k == dealt.rk) & (copies.b == dealt.rb), "left").where(
            "NOT s OR rk IS NOT NULL").drop("b", "s", "rb")
        assert split.columns == plain.columns and split.count() == 103
        assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0
        # a row of the right side is in one bucket, and several are used
        assert dealt.count() == 51
        if rows_per_task == 7:
            assert dealt.where("rk = 1").select("rb").distinct().count() > 3


def test_rows_without_a_key_spread_over_the_tasks(spark):
    left = spark.range(4000).selectExpr("if(id % 4 = 0, cast(id as string), null) k", "id v")
    right = spark.range(4000).selectExpr("if(id % 3 = 0, null, cast(id as string)) rk", "id w")
    out = left_join_nullable_key(left, right, "k", "rk")
    assert out.columns == ["k", "v", "rk", "w"]
    plain = left.join(right, left.k == right.rk, "left")
    assert out.exceptAll(plain).count() == 0 and plain.exceptAll(out).count() == 0
    with session_conf(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        spread = out.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) > 1 and max(r["count"] for r in spread) < 1000


def test_visit_mart_with_split_visits_equals_plain(spark):
    from visitlens.plans import registry as R

    sf = "/root/testdata/sf0.001"
    split, plain = R.q_visit_mart_salted(spark, sf), R.q_visit_mart(spark, sf)
    assert split.count() == plain.count()
    assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0


def test_broadcast_bound_is_measured_on_every_call(spark):
    from visitlens.operators.joins import has_at_most
    from visitlens.session import scratch_path

    path = scratch_path(spark, "grown")
    spark.range(5).write.parquet(path)
    df = spark.read.parquet(path)
    assert has_at_most(df, 10)
    spark.range(1000).write.mode("overwrite").parquet(path)
    assert not has_at_most(spark.read.parquet(path), 10)
    assert not has_at_most(spark.range(1).selectExpr("array(id) as a"), 10)   # size unknown

