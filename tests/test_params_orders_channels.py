"""Golden rows: URL parameters (3.3), order fields (3.4), channels (3.6)."""

import random
import string

from pyspark.sql import functions as F

from conftest import rows
from visitlens.config import ChannelRules
from visitlens.functions import channels as CH
from visitlens.functions import orders as O
from visitlens.functions import params as P

PARAM_CASES = [
    ("campaign_id", "?campaignid=12", "12"),
    ("campaign_id", "?campaignid12", "12"),
    ("campaign_id", "?CampaignId=12", ""),
    ("mms_campaign_id", "?cid=AB1", "AB1"),
    ("mms_campaign_id", "?utm_cid=z", "z"),
    ("mms_campaign_id", "?placid=zz", "zz"),
    ("mms_campaign_id", "?product_id=P9&cid=1", "P9"),
    ("utm_source", "?utm_source=google1", "google"),
    ("utm_source", "?utm_source=Google", ""),
    ("mms_channel_id", "?chid=4272", "4272"),
    ("mms_channel_id", "?chid=x", ""),
    ("adgroup_id", "?adgroupid=7", "7"),
    ("keyword_id", "?kwd-55", "55"),
    ("keyword_id", "?kwd=55", ""),
    ("product_id", "?product_id=P9", "p9"),
    ("product_id", "?adtype=pla&cid=Z", ""),
    ("creative_id", "?creative=5", "5"),
    ("creative_id", "?adid=6", "6"),
]


def test_url_params_golden(spark):
    df = spark.createDataFrame([("https://h/p" + frag,) for _, frag, _ in PARAM_CASES], "url string")
    out = df.select(*P.url_param_columns("url"))
    got = out.collect()
    for (name, frag, want), row in zip(PARAM_CASES, got):
        assert row[name] == want, (name, frag, row[name])


def test_url_params_null_url_and_dsa(spark):
    df = spark.createDataFrame([(None,), ("https://h/?DSA-1",), ("https://h/?dat-2",)], "url string")
    out = df.select(P.campaign_id("url"), P.product_id("url"), P.is_dsa_ad("url"))
    assert rows(out) == [(None, None, False), ("", "", True), ("", "", True)]


def test_product_id_fallback_flag(spark):
    df = spark.createDataFrame([("https://h/?adtype=pla&cid=Z",)], "url string")
    assert rows(df.select(P.product_id("url", null_on_miss=True))) == [("z",)]


LOOKBEHIND = {
    "campaign_id": ("(?<=campaignid)\\=?([0-9]+)", 1),
    "mms_campaign_id": ("(?<=cid|utm_cid|product_id)\\=?([A-Za-z0-9]+)", 1),
    "mms_channel_id": ("(?<=chid)\\=?([0-9]+)", 1),
    "adgroup_id": ("(?<=adgroupid)\\=?([0-9]+)", 1),
    "creative_id": ("(?<=creative|adid)\\=?([0-9]+)", 1),
}


def test_plain_patterns_equal_lookbehind_on_random_urls(spark):
    """Property: the plain patterns find what the look-behind form finds."""
    rnd = random.Random(7)
    words = ["cid", "utm_cid", "product_id", "campaignid", "chid", "adgroupid", "creative",
             "adid", "placid", "=", "&", "?", "-", "x", "9", "Z", "cidcid", "id"]
    urls = ["https://h/p?" + "".join(rnd.choice(words + list(string.ascii_letters[:6] + "0123"))
                                     for _ in range(rnd.randint(1, 14))) for _ in range(3000)]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    cols = []
    for name, (pat, g) in LOOKBEHIND.items():
        plain = getattr(P, name)(F.col("url"))
        cols.append((plain == F.regexp_extract("url", pat, g)).alias(name))
    bad = df.select(*cols).where(~F.array_min(F.array(*[F.col(n) for n in LOOKBEHIND])))
    assert bad.count() == 0


def test_order_fields_golden(spark):
    df = spark.createDataFrame(
        [("web-801-12", "c", "PAID", "Cancelled"),
         ("web-801", "", "PARTIALLY_PAID", "Shipped"),
         (None, None, "AUTHORIZED", "Cancelled"),
         ("a-b-c-d", None, "AUTHORIZED", "Issue Refund"),
         ("x", None, "AUTHORIZED", "Shipped"),
         ("x", None, "PENDING", "Cancelled"),
         ("x", None, None, None)],
        "order_id string, cancelled string, pay string, status string")
    out = df.select(O.order_part("order_id", 3), O.cancel_flag("cancelled"),
                    O.order_cancelled("pay", "status"))
    assert rows(out) == [("12", 1, False), (None, 1, False), (None, None, True),
                         ("c", None, True), (None, None, None), (None, None, None),
                         (None, None, None)]


CHANNEL_CASES = [
    # url channel id, source, medium, provider, referrer type, referrer name, url, utm -> id, label
    ("4274", "facebook", None, None, None, None, None, None, "4274", "Google Remarketing"),
    ("", "Google PLA", None, None, None, None, None, None, "4272", "Google PLA"),
    (None, "google", None, None, None, None, "https://h/?pla-1", None, "4272", "Google PLA"),
    (None, None, "cpc", "Google", None, None, None, None, "4272", "Google PLA"),
    (None, "bingpla", None, None, None, None, None, None, "4282", "Bing PLA"),
    (None, "bing", None, None, None, None, "https://h/?pla-1", None, "4282", "Bing PLA"),
    (None, None, "cpc", "bing", None, None, None, None, "4282", "Bing PLA"),
    (None, "google text models", None, None, None, None, None, None, "1", "Google Text"),
    (None, None, "text", "google", None, None, None, None, "1", "Google Text"),
    (None, "bing text general", None, None, None, None, None, None, "1600", "Bing Text"),
    (None, None, None, None, None, None, None, "mailmodo", "4", "Mailmodo"),
    (None, "MailModo", None, None, None, None, None, None, "4", "Mailmodo"),
    (None, "facebookads", None, None, None, None, None, None, "4292", "Facebook"),
    (None, None, None, None, None, "Facebook", None, None, "4292", "Facebook"),
    (None, None, None, "facebook", None, None, None, None, "4292", "Facebook"),
    (None, None, None, None, None, None, "https://h/?cjevent=1", None, "2100", "Commission Junction"),
    (None, None, None, None, None, "pinterest", None, None, "4275", "Pinterest"),
    (None, None, None, None, "direct", None, None, None, "0", "Organic"),
    (None, None, None, None, "search", None, None, None, None, "Unknown"),
    ("99", None, None, None, None, None, None, None, "99", "Unknown"),
    (None, "facebook", "cpc", "google", None, None, None, None, "4272", "Google PLA"),
]


def test_channel_rules_golden(spark):
    schema = ("ucid string, src string, med string, prov string, rtype string, rname string, "
              "url string, utm string")
    df = spark.createDataFrame([c[:8] for c in CHANNEL_CASES], schema)
    cid = CH.channel_id("ucid", "src", "med", "prov", "rtype", "rname", "url", "utm")
    out = df.select(cid.alias("c")).select("c", CH.channel_label("c"))
    assert rows(out) == [c[8:] for c in CHANNEL_CASES]


def test_google_display_and_custom_labels(spark):
    df = spark.createDataFrame([("Google Display",), ("x",), (None,)], "s string")
    assert rows(df.select(CH.is_google_display_ad("s"))) == [(True,), (False,), (False,)]
    custom = ChannelRules(labels=(("7", "Seven"),), unknown_label="n/a")
    lab = spark.createDataFrame([("7",), ("8",)], "c string").select(CH.channel_label("c", custom))
    assert rows(lab) == [("Seven",), ("n/a",)]
