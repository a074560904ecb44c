"""Scalar column functions: edge vectors from the fixture notes."""

import math

import pytest
from pyspark.sql import functions as F

from marketlens.functions import numbers as N
from marketlens.functions import text as TX

PARSE_CASES = [
    ("74K", 74000), ("1.2M", 1200000), ("$5.20", 5.2), ("72", 72), ("1,234", 1234), ("5 %", 5),
    ("2.1b", 2100000000), ("12 K", 12000), ("-3", -3), (".5", 0.5), ("1.5e3", 1500),
    (None, 0), ("", 0), ("n/a", 0), ("-", 0), ("—", 0), ("abc", 0), ("1e5", 0), ("<0.01", 0),
    ("K", 0), ("nan", 0), ("inf", 0), ("infM", 0), ("7d", 0), ("7.5f", 0), ("  42  ", 42),
    ("N/A", 0), ("3.7k", 3700), ("–12", 12),
]


def _eval(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_parse_number_vectors(spark):
    got = _eval(spark, [v for v, _ in PARSE_CASES], N.parse_number)
    for (raw, want), g in zip(PARSE_CASES, got):
        assert g == pytest.approx(want), raw


def test_parse_number_truncates_after_multiply(spark):
    # int(float('1.9999K') * 1000) == 1999 (truncation, not rounding)
    assert _eval(spark, ["1.9999K", "-2.5K"], N.parse_number) == [1999.0, -2500.0]


def test_parse_cpc_drops_empty_and_bad(spark):
    assert _eval(spark, ["$5.20", "", "n/a", "$1,200.50", None, " 3 "], N.parse_cpc) == \
        [5.2, None, None, 1200.5, None, 3.0]


def test_legacy_volume(spark):
    # textual K -> 000 makes 1.2K read as 1.2 (kept on purpose)
    assert _eval(spark, ["1.2K", "12K", "2M", "1,000", "n/a", "1.2.3", "5k"], N.parse_volume_legacy) == \
        [1.2, 12000.0, 2000000.0, 1000.0, None, None, None]


def test_intent_labels(spark):
    assert _eval(spark, ["T", "C", "I", "N", "Commercial", "x", None], N.intent_label) == \
        ["Transactional", "Commercial", "Informational", "Navigational", "Commercial", "Unknown", "Unknown"]


def test_first_int(spark):
    assert _eval(spark, ["5 stars", "Rated 4 out of 5", "none", None], N.first_int) == [5, 4, None, None]


def test_score_gate_and_safe_div(spark):
    df = spark.createDataFrame([(0.0, 0.0), (50.0, 2.0), (101.0, -1.0)], "v double, d double")
    out = df.select(N.score_gate("v").alias("g"), N.safe_div("v", "d").alias("r")).collect()
    assert [(r.g, r.r) for r in out] == [(0.0, 0.0), (50.0, 25.0), (0.0, 0.0)]


def test_decimal_round_is_half_up(spark):
    assert _eval(spark, [2.125, 2.675, 0.5, 1.005], lambda c: N.dround(c, 2), "double") == \
        [2.13, 2.68, 0.5, 1.01]


def test_sentiment_lexicon(spark):
    texts = ["Great product, love it", "terrible and awful, but great", "nothing here", None, "",
             "best worst"]
    got = _eval(spark, texts, TX.lexicon_sentiment)
    assert got == pytest.approx([1.0, -1 / 3, 0.0, 0.0, 0.0, 0.0])


def test_complaint_categories_all_ten(spark):
    texts = ["Way too expensive", "rude staff", "cheap quality", "weak scent", "wick tunnel",
             "did not last", "arrived late", "long line at the store", "refund refused", "fake one",
             "lovely", None, "", "rude and overpriced, box damaged"]
    got = _eval(spark, texts, TX.complaint_categories)
    assert got[:10] == [["price_value"], ["customer_service"], ["product_quality"], ["scent_issues"],
                        ["burn_quality"], ["longevity"], ["shipping"], ["store_experience"],
                        ["return_refund"], ["authenticity"]]
    assert got[10:13] == [["other"]] * 3
    # multi-label, lexicon order, one hit per category
    assert got[13] == ["price_value", "customer_service", "product_quality", "shipping"]


def test_trigger_tell_tales(spark):
    kws = ["how much to ship a car", "top rated car shipping companies", "vvs diamonds",
           "car shipping", "best car shipping", "compare quotes", "shipping fee"]
    assert _eval(spark, kws, TX.trigger_category) == [
        "informational", "cost", "comparison", "transactional", "recommendation", "comparison", "cost"]


def test_text_cleaning(spark):
    from marketlens.functions.stopwords import ENGLISH_STOPWORDS
    got = _eval(spark, ["The Candle's wick, burnt 2x!!  Really bad"],
                lambda c: TX.processed_text(c, ENGLISH_STOPWORDS))
    assert got == ["candles wick burnt really bad"]


def test_display_and_ellipsis(spark):
    assert _eval(spark, ["price_value"], TX.display_label) == ["PRICE VALUE"]
    long = "x" * 151
    assert _eval(spark, [long, "short"], TX.ellipsis) == ["x" * 150 + "...", "short"]


def test_upper_median_matches_sorted_index(spark):
    from marketlens.operators.paid import industry_averages
    for n in (1, 2, 3, 4, 7, 10):
        vals = list(range(1, n + 1))
        pool = spark.createDataFrame([(float(v), None) for v in vals], "cpc double, volume double")
        one = spark.createDataFrame([(0,)], "k long")
        med = industry_averages(pool, one, one.withColumnRenamed("k", "c")).collect()[0]["median_cpc"]
        assert med == sorted(vals)[n // 2], n
    assert not math.isnan(1.0)
