"""Exact sums of doubles against rational arithmetic."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from visitlens.functions import exact


def half_away(value: Fraction, places: int) -> float:
    scaled = abs(value) * 10 ** places
    whole = math.floor(scaled + Fraction(1, 2))
    return math.copysign(float(Fraction(whole, 10 ** places)), value) + 0.0


def groups():
    rng = random.Random(12)
    out = {
        "cents": [rng.randint(-10**6, 10**6) / 100 for _ in range(400)],
        "tie_up": [0.125, 1.0, -1.0], "tie_down": [-0.125], "below_tie": [0.125, -2.0 ** -66],
        "above_tie": [-0.125, 2.0 ** -66], "decimals": [rng.random() * 10 ** -rng.randint(0, 13) for _ in range(300)],
        "tiny": [1e-13] * 7 + [0.005], "cancel": [1e17, 0.01, -1e17, 0.015], "wide": [1e18, 1e-18, -1e18, 2.5],
        "mixed": [rng.uniform(-1, 1) * 10.0 ** rng.randint(-15, 12) for _ in range(300)],
        "zero": [0.0, -0.0], "minus": [-0.004], "one": [64517.5575, 64517.5575], "null": [None, None],
        "some_null": [None, 1.5],
    }
    return out


@pytest.mark.parametrize("parts", [1, 5])
def test_sums_equal_rational_arithmetic(spark, parts):
    data = groups()
    rows = [(k, v) for k, values in data.items() for v in values]
    random.Random(parts).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, x double").repartition(parts)
    # summed in two levels, as in the SKU job
    df = df.withColumn("h", exact.held("x"))
    inner = df.groupBy("k", F.spark_partition_id().alias("p")).agg(exact.exact_sum("x", "h").alias("s"))
    inner = inner.withColumn("s", exact.carried("s"))
    total = inner.groupBy("k").agg(exact.merged_sum("s").alias("s")).withColumn("s", exact.carried("s"))
    total = total.withColumn("t", exact.times("s", "3L")).withColumn("t", exact.carried("t"))
    got = total.select("k", exact.rounded("s", 2).alias("two"), exact.rounded("s", 6).alias("six"),
                       exact.rounded("t", 2).alias("three")).collect()
    assert len(got) == len(data)
    for r in got:
        values = [v for v in data[r.k] if v is not None]
        if not values:
            assert r.two is r.six is r.three is None
            continue
        s = sum(map(Fraction, values), Fraction(0))
        assert (r.two, r.six, r.three) == (half_away(s, 2), half_away(s, 6), half_away(3 * s, 2)), r.k


def test_what_digits_cannot_hold_is_a_plain_sum(spark):
    rows = [("nan", float("nan")), ("nan", 1.0), ("inf", float("inf")), ("inf", 2.0), ("huge", 1e300), ("huge", 1e299)]
    df = spark.createDataFrame(rows, "k string, x double")
    df = df.withColumn("h", exact.held("x"))
    out = df.groupBy("k").agg(exact.exact_sum("x", "h").alias("s")).withColumn("s", exact.carried("s"))
    got = {r.k: r.v for r in out.select("k", exact.rounded("s", 2).alias("v")).collect()}
    assert math.isnan(got["nan"]) and got["inf"] == math.inf and got["huge"] == pytest.approx(1.1e300)
