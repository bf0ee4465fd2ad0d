"""Property test: channel id and label against a first-match Python model.

The test data's campaign attributes are correlated, so not every rule fires
there; random combinations of the values each rule looks at cover the whole
cascade, including NULLs and case variants.
"""

import random

from visitlens.config import ChannelRules
from visitlens.functions import channels as CH

R = ChannelRules()


def low(x):
    return None if x is None else x.lower()


def eq(a, b):
    return None if a is None or b is None else a == b


def any_true(*xs):
    """SQL OR: true if any true, else NULL if any NULL, else false."""
    if any(x is True for x in xs):
        return True
    return None if any(x is None for x in xs) else False


def all_true(*xs):
    if any(x is False for x in xs):
        return False
    return None if any(x is None for x in xs) else True


def isin(x, values):
    return None if x is None else x in values


def like(x, needle):
    return None if x is None else needle in x


def channel_model(ucid, src, med, prov, rtype, rname, url, utm):
    if ucid is not None and ucid != "":
        return ucid
    s, m, p = low(src), low(med), low(prov)
    rules = [
        (isin(s, R.google_pla_sources), "4272"),
        (any_true(all_true(eq(s, "google"), like(url, "pla-")), all_true(eq(p, "google"), eq(m, "cpc"))), "4272"),
        (isin(s, R.bing_pla_sources), "4282"),
        (any_true(all_true(eq(s, "bing"), like(url, "pla-")), all_true(eq(p, "bing"), eq(m, "cpc"))), "4282"),
        (any_true(isin(s, R.google_text_sources), all_true(eq(p, "google"), eq(m, "text"))), "1"),
        (any_true(isin(s, R.bing_text_sources), all_true(eq(p, "bing"), eq(m, "text"))), "1600"),
        (any_true(eq(src if src is not None else utm, "mailmodo"), isin(s, R.mailmodo_sources)), "4"),
        (any_true(isin(s, R.facebook_sources), eq(low(rname), "facebook"), eq(p, "facebook")), "4292"),
        (None if url is None else ("cjevent" in url.lower() or "mms_chref=cj" in url.lower()), "2100"),
        (eq(low(rname), "pinterest"), "4275"),
        (eq(low(rtype), "direct"), "0"),
    ]
    for cond, value in rules:
        if cond is True:
            return value
    return None


def label_model(cid):
    return dict(R.labels).get(cid, R.unknown_label) if cid is not None else R.unknown_label


CHOICES = {
    "ucid": [None, "", "4274", "99", "4272"],
    "src": [None, "Google PLA", "google", "Google", "bing", "bingpla", "google text models",
            "bing text general", "mailmodo", "MailModo", "3dmailmodo", "facebookads",
            "Social-FB", "google display", "other"],
    "med": [None, "cpc", "CPC", "text", "email"],
    "prov": [None, "google", "Google", "bing", "facebook", "other"],
    "rtype": [None, "campaign", "direct", "Direct", "search"],
    "rname": [None, "facebook", "Facebook", "pinterest", "other"],
    "url": [None, "https://h/p?pla-1", "https://h/p?cjevent=1", "https://h/?mms_chref=cj",
            "https://h/p", "https://h/P?PLA-1"],
    "utm": [None, "mailmodo", "google", ""],
}


def test_channel_rules_match_model(spark):
    rnd = random.Random(5)
    names = list(CHOICES)
    data = [tuple(rnd.choice(CHOICES[n]) for n in names) for _ in range(3000)]
    df = spark.createDataFrame(data, ", ".join(f"{n} string" for n in names))
    cid = CH.channel_id(*names)
    got = df.select(*names, cid.alias("cid"), CH.channel_label(cid).alias("label")).collect()
    bad = []
    for r in got:
        row = tuple(r[n] for n in names)
        want = channel_model(*row)
        if r["cid"] != want or r["label"] != label_model(want):
            bad.append((row, r["cid"], r["label"], want))
    assert not bad, bad[:5]
