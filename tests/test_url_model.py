"""URL functions on URLs assembled from known parts.

Each case picks what a URL shall mean - its folder, its last segment and that
segment's suffix, a trailing slash, a query - and writes the URL from that, so the
expected answer is known from the making and no second parser is needed.
"""

import itertools

from visitlens import config as C
from visitlens.functions import urls as U

HOST = "https://www.shop.example"
# suffix of the last segment -> what the ad rule and the visit rule make of it: the whole
# segment, the part before the suffix ("stem"), or no SKU (None)
SUFFIXES = {
    "": ("whole", "whole"),
    "-n": ("stem", "stem"),
    "-R": ("stem", "stem"),       # paths are lower-cased first
    "-u": ("stem", "whole"),      # a code of ads only
    "-o": ("whole", "whole"),     # one letter of a longer code is none
    "-ob": ("whole", "whole"),
    "-bo": (None, "whole"),       # the two-letter codes are found but cannot be stripped
    "-rm": (None, "whole"),
    "-rc": (None, "whole"),
    "-x": ("whole", "whole"),
    "-nn": ("whole", "whole"),
    "-r-n": ("stem", "stem"),     # only the last suffix counts
    "-r-x": ("whole", "whole"),
}
# folder and segment that name a container -> ad rule, visit rule, join key
CONTAINERS = {
    "/details/56/": ("56", "56", "56"),
    "/details/56": ("56", "56", "56"),
    "/details/56-78/": ("78", "78", "56"),
    "/details/56-78": ("56", "56", "56"),      # a pair counts only before a slash
    "/details/0-78/": ("78", "78", "78"),
    "/details/0-78": ("0", "0", None),
    "/details/00-78/": ("78", "78", "00"),
    "/mydetails/56-78/": (None, "56", "56"),   # a pair in a folder of another name
    "/mydetails/0-78/": (None, "0", None),
    "/DETAILS/56-78/": ("78", "78", "56"),
    "/details/x56/": (None, None, None),
    "/product/56/": (None, None, None),
}
QUERIES = ["", "?", "?ref=a-n/b", "?to=/details/9-8/"]


def answers(spark, urls, **columns):
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    rows = df.select("url", *[c.alias(n) for n, c in columns.items()]).collect()
    return {r["url"]: tuple(r[n] for n in columns) for r in rows}


def test_sku_of_the_last_segment(spark):
    want = {}
    for suffix, folder, slash, query in itertools.product(
            SUFFIXES, ["/", "/product/", "/details/5-7/"], ["", "/"], QUERIES):
        whole = f"Lamp-40{suffix}"
        made = {"whole": whole.lower(), "stem": whole.rpartition("-")[0].lower(), None: None}
        want[f"{HOST}{folder}{whole}{slash}{query}"] = tuple(made[k] for k in SUFFIXES[suffix])
    assert answers(
        spark, want, ad=U.sku_from_path(U.url_path("url"), C.AD_SUFFIX_CODES, C.AD_SUFFIX_STRIP),
        visit=U.sku_from_path(U.clean_url("url"), C.VISIT_SUFFIX_CODES, C.VISIT_SUFFIX_STRIP)) == want


def test_container_of_the_path(spark):
    want = {f"{HOST}{path}{rest}{query}": found for (path, found), rest, query in itertools.product(
        CONTAINERS.items(), ["", "name-12"], QUERIES) if path.endswith("/") or not rest}
    path = U.url_path("url")
    assert answers(spark, want, ad=U.container_id(path, C.AD_CONTAINER_TEST),
                   visit=U.container_id(U.clean_url("url"), C.VISIT_CONTAINER_TEST),
                   key=U.container_join_key(path)) == want


def test_ids_in_the_query(spark):
    want = {}
    for name, number, before, after in itertools.product(
            ["catalogitemid", "CatalogItemId", "category_id", "other_id"], ["", "0", "5512"],
            ["", "x=1&"], ["", "&y=2", "z"]):
        url = f"{HOST}/product/a?{before}{name}={number}{after}"
        want[url] = ((number or None) if name.lower() == "catalogitemid" else None,
                     (number or None) if name == "category_id" else None)
    assert answers(spark, want, item=U.catalog_item_id("url"), category=U.category_id("url")) == want


def test_clean_path_and_last_segment(spark):
    want = {}
    for junk, segment, query in itertools.product(
            ["", "€", "â\u008d", "€€"], ["", "Sofa", "sofa-n"], QUERIES):
        want[f"{HOST}/Pro{junk}duct/{junk}{segment}{query}"] = (
            f"{HOST}/product/{segment.lower()}", segment.lower())
    clean = U.clean_url("url")
    assert answers(spark, want, clean=clean, last=U.last_segment(clean)) == want
