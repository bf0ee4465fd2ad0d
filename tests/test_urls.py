"""Golden rows for the URL functions (FIXTURES.md 3.1, 3.2, 3.5) and properties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from visitlens import config as C
from visitlens.config import SiteRules
from visitlens.functions import urls as U

SKU_CASES = [
    # url, ads SKU (new site, before map fallback), visit SKU (site id 69)
    ("https://h/product/SKU-1-N/?x=1", "sku-1", "sku-1"),
    ("https://h/product/sku-1-r", "sku-1", "sku-1"),
    ("https://h/product/sku-1", "sku-1", "sku-1"),
    ("https://h/product/sku-n", "sku", "sku"),
    ("https://h/product/n", None, None),
    ("https://h/product//", None, None),
    ("https://h/product/sku-1-bo", None, "sku-1-bo"),
    ("https://h/product/sku-1-u", "sku-1", "sku-1-u"),
    ("https://h/product/sku-1-o", "sku-1-o", "sku-1-o"),
    ("https://h/product/sku-1â€\u008d-n", "sku-1â€\u008d", "sku-1"),
    ("https://h/products/a.jpg", "a.jpg", "a.jpg"),
]


def test_sku_from_url_golden(spark):
    df = spark.createDataFrame([(u,) for u, _, _ in SKU_CASES], "url string")
    out = df.select(
        U.ad_sku(F.lit(C.NEXTGEN), U.url_path("url")).alias("ads"),
        U.visit_sku(F.lit(69), U.clean_url("url")).alias("visit"))
    assert rows(out) == [(a, v) for _, a, v in SKU_CASES]


def test_sku_only_for_sku_sites(spark):
    df = spark.createDataFrame([("https://h/product/sku-1",)], "url string")
    out = df.select(U.ad_sku(F.lit(C.LEGACY), U.url_path("url")).alias("a"),
                    U.visit_sku(F.lit(12), U.clean_url("url")).alias("v"),
                    U.product_identifier(F.lit(12), U.clean_url("url")).alias("p"),
                    U.strip_sku_text(F.lit("a.jpg")).alias("s"))
    assert rows(out) == [(None, None, "sku-1", "a.")]


CONTAINER_CASES = [
    # path, projected (P5/P7), join/group key
    ("h/details/0-7/x", "7", "7"),
    ("h/details/5-7/x", "7", "5"),
    ("h/details/5/x", "5", "5"),
    ("h/details/5-7", "5", "5"),
    ("h/details/0-7", "0", None),
    ("h/details/00-7/x", "7", "00"),
    ("h/product/x", None, None),
]


@pytest.mark.parametrize("test_pattern", [C.AD_CONTAINER_TEST, C.VISIT_CONTAINER_TEST])
def test_container_ids_golden(spark, test_pattern):
    df = spark.createDataFrame([(p,) for p, _, _ in CONTAINER_CASES], "path string")
    out = df.select(U.container_id("path", test_pattern).alias("proj"),
                    U.container_join_key("path").alias("key"))
    assert rows(out) == [(p, k) for _, p, k in CONTAINER_CASES]


def test_ids_from_query_string(spark):
    df = spark.createDataFrame([("https://h/x?Category_ID=12&CatalogItemId=501",),
                                ("https://h/x?category_id=&catalogitemid=a",)], "url string")
    out = df.select(U.category_id("url"), U.catalog_item_id("url"))
    assert rows(out) == [("12", "501"), (None, None)]


def test_clean_url_removes_each_char_and_is_idempotent(spark):
    raw = "https://H/Product/ABCâ€\u008d-N/?X=1&â=2"
    df = spark.createDataFrame([(raw,), ("https://h/p/€",), (None,)], "url string")
    once = df.select(U.clean_url("url").alias("c"))
    twice = once.select(U.clean_url("c").alias("c"))
    assert rows(once) == [("https://h/product/abc-n/",), ("https://h/p/",), (None,)]
    assert rows(twice) == rows(once)
    assert rows(df.select(U.url_path("url")))[0] == ("https://h/product/abcâ€\u008d-n/",)


def test_product_page_and_exclusions(spark):
    df = spark.createDataFrame([("https://h/Products/x?searchterm=1",), ("https://h/cart",),
                                ("https://h/details/1?onerror=x",)], "url string")
    out = df.select(U.is_product_page("url", C.AD_PRODUCT_PAGE),
                    U.is_product_page("url", C.VISIT_PRODUCT_PAGE),
                    U.not_search("url"), U.not_exploit("url"))
    assert rows(out) == [(False, True, False, True), (False, False, True, True),
                         (True, True, True, False)]


def test_pla_product_id(spark):
    df = spark.createDataFrame([("NG123", C.NEXTGEN), ("NG123", C.LEGACY), ("x", C.NEXTGEN)],
                               "item string, site string")
    out = df.select(U.pla_product_id("item", "site"), U.ng_product_id("item"))
    assert rows(out) == [("123", "123"), (None, "123"), (None, None)]


RULES = SiteRules(cutover=dt.date(2023, 6, 30), early_prefixes=("https://online.shop.example",),
                  early_hosts=(".shoponline.example",), host="www.shop.example")
SITE_CASES = [
    (dt.datetime(2023, 6, 30, 23), "https://online.shop.example/a", C.NEXTGEN),
    (dt.datetime(2023, 6, 1), "https://x.shoponline.example/a", C.NEXTGEN),
    (dt.datetime(2023, 6, 1), "https://www.shop.example/a", C.LEGACY),
    (dt.datetime(2023, 7, 1), "https://www.shop.example/product/a", C.NEXTGEN),
    (dt.datetime(2023, 7, 1), "https://WWW.shop.example/details/1", C.LEGACY),
    (dt.datetime(2023, 7, 1), "https://www.shop.example/account", C.LEGACY),
    (dt.datetime(2023, 7, 1), "https://online.shop.example/a", C.LEGACY),
    (dt.datetime(2023, 7, 1), None, C.LEGACY),
]


def test_site_from_url_golden(spark):
    df = spark.createDataFrame([(t, u) for t, u, _ in SITE_CASES], "ts timestamp_ntz, url string")
    assert rows(df.select(U.site_from_url("url", "ts", RULES))) == [(s,) for _, _, s in SITE_CASES]


def test_site_from_id(spark):
    df = spark.createDataFrame([(69,), (71,), (12,), (None,)], "site_id int")
    assert rows(df.select(U.site_from_id("site_id"))) == [
        (C.NEXTGEN,), (C.NEXTGEN,), (C.LEGACY,), (C.LEGACY,)]
