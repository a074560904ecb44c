"""Review operators on literal rows (edge cases the fixture tables lack)."""

from marketlens.operators import reviews as R
from marketlens.operators import textmining as TM

SCHEMA = "review_seq long, brand string, location string, text string, rating int"


def _reviews(spark, rows):
    return R.score_reviews(spark.createDataFrame(rows, SCHEMA))


def test_negative_filter_three_valued(spark):
    df = _reviews(spark, [(1, "a", "x", "terrible", None),   # NULL rating, sentiment -1 -> kept
                          (2, "a", "x", "fine", None),       # NULL rating, 0 -> dropped
                          (3, "a", "x", "fine", 2),          # rating 2 -> kept
                          (4, "a", "x", "fine", 5)])         # dropped
    assert sorted(r.review_seq for r in R.filter_negative(df).collect()) == [1, 3]
    # without a rating column: sentiment only
    assert [r.review_seq for r in R.filter_negative(df.drop("rating")).collect()] == [1]


def test_complaint_ranking_first_seen_ties(spark):
    rows = [(1, "b1", "x", "rude staff and cheap", 1),        # customer_service, product_quality
            (2, "b1", "x", "too expensive", 1),               # price_value
            (3, "b2", "x", "cheap and expensive", 1),         # price_value, product_quality
            (4, "b2", "x", "rude", 1)]                        # customer_service
    neg = R.filter_negative(_reviews(spark, rows))
    top = {r.category: (r.rank, r.n_reviews, r.pct) for r in R.top_complaints(neg).collect()}
    # all three have 2 reviews: order by first review, then lexicon order
    assert top["customer_service"][0] == 1 and top["product_quality"][0] == 2 and top["price_value"][0] == 3
    assert top["customer_service"][2] == 50.0
    by_brand = {(r.brand, r.category): r.rank for r in R.complaints_by_brand(neg).collect()}
    assert by_brand[("b2", "price_value")] == 1 and by_brand[("b2", "product_quality")] == 2


def test_samples_first_seen_order(spark):
    rows = [(i, "b", "x", t, 1) for i, t in enumerate(
        ["nice", "rude", "rude", "rude", "rude", "expensive"], start=1)]
    neg = R.filter_negative(_reviews(spark, rows))
    s = sorted((r.category_order, r.category, r.sample_rank, r.review_seq)
               for r in R.complaint_samples(neg).collect())
    assert s[0][:2] == (1, "other")
    assert [x[3] for x in s if x[1] == "customer_service"] == [2, 3, 4]
    assert s[-1][:2] == (3, "price_value")


def test_normalise_reviews(spark):
    raw = spark.createDataFrame([
        (1, "b", "x", None, "fallback element text long enough", "4 stars", None, None),
        (2, "b", "x", "short", "short", None, "ann", "1 day ago")],
        "review_seq long, brand string, location string, review_text string, element_text string, "
        "rating_label string, reviewer string, date string")
    out = R.normalise_reviews(raw).collect()
    assert len(out) == 1 and out[0].rating == 4 and out[0].reviewer == "Anonymous" and out[0].date == "Unknown"


def test_query_grid(spark):
    comps = spark.createDataFrame([("c", 1, None, "acme.com"), ("c", 2, "Beta", "beta.io")],
                                  "client_id string, seq int, name string, domain string")
    locs = spark.createDataFrame([("c", 0, "Paris")], "client_id string, seq int, location string")
    types = spark.createDataFrame([("c", 0, "store"), ("c", 1, "outlet")], "client_id string, seq int, store_type string")
    q = sorted(r.query for r in R.review_query_grid(comps, locs, types).collect())
    assert q == ["Beta outlet", "Beta store Paris", "acme outlet", "acme store Paris"]


def test_key_phrases_small_corpus(spark):
    docs = spark.createDataFrame([(1, "red candle burns slowly"), (2, "red candle smells nice"),
                                  (3, "blue box arrived")], "review_seq long, text string")
    kp = {r.gram: r.score for r in TM.key_phrases(TM.with_tokens(docs), n=5).collect()}
    # min_df 2: only grams present in two documents survive
    assert set(kp) == {"red", "candle", "red candle"}
    assert abs(kp["red"] - kp["candle"]) < 1e-9


def test_dashboard_keyword_dispatch(spark):
    from marketlens.operators.dashboard import transform_keyword_data
    rel = spark.createDataFrame([(1, "Car", 1.0, None, 2.0, None), (2, "car", 5.0, 3.0, None, "T"),
                                 (3, "", 9.0, 9.0, 9.0, "C")],
                                "seq long, keyword string, volume double, kd double, cpc double, intent string")
    got = {r.keyword: tuple(r)[1:] for r in transform_keyword_data(rel).collect()}
    assert got == {"car": (5.0, 3.0, 0.0, "T")}          # last wins, defaults, empty skipped
    ready = transform_keyword_data(rel.drop("seq"))
    assert ready.count() == 3                            # already keyed: passed through


def test_pluggable_scorer(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, "b", "x", "whatever text", None)], SCHEMA)
    out = R.score_reviews(df, scorer=lambda c: F.lit(-0.5)).collect()[0]
    assert out.sentiment == -0.5 and out.categories == ["other"]


def test_scraped_text_is_stripped_before_the_length_rule(spark):
    from marketlens.operators.reviews import normalise_reviews
    raw = spark.createDataFrame([(1, "   hi       ", " Bob ", "\n"), (2, "\n a long enough text \t", None, None)],
                                "review_seq long, review_text string, reviewer string, date string").selectExpr(
        "*", "'b' as brand", "'l' as location", "'x' as element_text", "'4 stars' as rating_label")
    assert [(r.review_seq, r.text, r.reviewer) for r in normalise_reviews(raw).collect()] == [(2, "a long enough text", "Anonymous")]


def test_blank_cards_are_dropped_first(spark):
    from marketlens.operators.paid import advertising_cards
    cards = spark.createDataFrame([("d", ["", "10", " ", "20", "$30"]), ("e", ["", "1"])], "domain string, values array<string>")
    got = {r.domain: tuple(r)[1:] for r in advertising_cards(cards).collect()}
    assert got == {"d": ("10", "20", "$30", "10"), "e": (None, None, None, "1")}
