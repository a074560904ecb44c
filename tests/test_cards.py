"""Page cards: goldens by hand, malformed pages."""

import json

import pytest
from pyspark.sql import functions as F

from marketlens.operators import cards as C


def page(spark, page_type, *elements):
    rows = [("c", page_type, "s", json.dumps([dict(zip(("kind", "name", "text", "parent"), (*e, "")[:4])) for e in elements]))]
    return spark.createDataFrame(rows, "client_id string, page_type string, subject string, j string").select(
        "client_id", "page_type", "subject", F.parse_json("j").alias("elements"))


def only(df):
    [row] = df.collect()
    return row.asDict()


KEYWORDS = [
    # named fields win; the later name wins where it says anything
    ([("field", "volume", "1K"), ("field", "keyword-overview-volume", "2K"), ("field", "cpc", "$1"), ("card", "", "9"), ("card", "", "8"), ("card", "", "7")],
     (2000.0, 0.0, 1.0, "Unknown")),
    # no volume: cards say volume and, from three on, CPC, even over a named CPC
    ([("field", "cpc", "$1"), ("card", "", "9"), ("card", "", " "), ("card", "", "8"), ("card", "", "7")], (9.0, 0.0, 7.0, "Unknown")),
    ([("field", "volume", "0"), ("field", "cpc", "$1"), ("card", "", "9"), ("card", "", "8")], (9.0, 0.0, 1.0, "Unknown")),
    # a later name that says 0 wins too, and then the cards speak
    ([("field", "volume", "5"), ("field", "keyword-overview-volume", "0"), ("card", "", "9")], (9.0, 0.0, 0.0, "Unknown")),
    # only the first element of a name counts
    ([("field", "volume", ""), ("field", "volume", "5")], (0.0, 0.0, 0.0, "Unknown")),
    ([("gauge", "", "130"), ("gauge", "", "0"), ("gauge", "", "45%"), ("gauge", "", "50")], (0.0, 45.0, 0.0, "Unknown")),
    ([("field", "keyword-difficulty", "70"), ("field", "kd", ""), ("gauge", "", "45")], (0.0, 70.0, 0.0, "Unknown")),
    # intents: a code or word stops the search; other texts go by their letters, the last one counting
    ([("intent", "", "abc"), ("intent", "", "N"), ("intent", "", "T")], (0.0, 0.0, 0.0, "Navigational")),
    ([("intent", "", "informational")], (0.0, 0.0, 0.0, "Informational")),
    ([("intent", "", "Informational")], (0.0, 0.0, 0.0, "Transactional")),
    ([("intent", "", "Commercial"), ("intent", "", "???"), ("intent", "", "xyz in")], (0.0, 0.0, 0.0, "Informational")),
    ([], (0.0, 0.0, 0.0, "Unknown")),
]


@pytest.mark.parametrize("elements, want", KEYWORDS)
def test_keyword_overview(spark, elements, want):
    row = only(C.keyword_overview(page(spark, "keyword_overview", *elements)))
    assert (row["volume"], row["kd"], row["cpc"], row["intent"]) == want


def test_lookup_takes_the_most_particular_cards(spark):
    two = page(spark, "keyword_lookup", ("card", "metric", "m"), ("card", "report-card", ""), ("card", "keyword-overview", ""))
    assert only(C.keyword_lookup(two)) == {"client_id": "c", "subject": "s", "volume_raw": "m", "cpc_raw": None, "competition_raw": None}
    mixed = page(spark, "keyword_lookup", ("card", "report-card", "a"), ("card", "keyword-overview", " b"), ("card", "keyword-overview", "c"))
    assert only(C.keyword_lookup(mixed))["volume_raw"] == " b"


def test_backlink_cards_fill_what_is_still_zero(spark):
    row = only(C.backlink_overview_cards(page(spark, "backlink_overview", ("field", "backlinks", "0"), ("field", "referring-ips", "5"),
                                              ("field", "authority-score", "40"), ("card", "", "1"), ("card", "", "2K"), ("card", "", "3"))))
    assert [row[f] for f in C.BACKLINK_FIELDS] == [40.0, 2000.0, 3.0, 5.0]


def test_malformed_pages_are_empty_pages(spark):
    odd = spark.createDataFrame([("c", t, s, j) for t in ("ai_overview", "brand_performance", "growth_actions", "keyword_overview")
                                 for s, j in (("object", '{"error": 403}'), ("null", None), ("text", '"x"'), ("empty", "[]"), ("bare", '[{"kind": "card"}]'))],
                                "client_id string, page_type string, subject string, j string").withColumn("elements", F.parse_json("j")).drop("j")
    assert {(r.ai_visibility_score, tuple(r.platforms)) for r in C.ai_overview(odd).collect()} == {(0.0, ())}
    assert {tuple(r.raw_metrics) for r in C.brand_performance(odd).collect()} == {()}
    assert C.growth_actions(odd).collect() == []
    assert {(r.volume, r.intent) for r in C.keyword_overview(odd).collect()} == {(0.0, "Unknown")}


def test_platforms_actions_and_referring_domains(spark):
    row = only(C.ai_overview(page(spark, "ai_overview", ("card", "", "12"), ("platform", "", " X "), ("platform", "", "ChatGPT"), ("platform", "", "ChatGPT"))))
    assert (row["ai_visibility_score"], row["ai_mentions"], row["platforms"]) == (12.0, 0.0, ["ChatGPT", "ChatGPT"])
    got = C.growth_actions(page(spark, "growth_actions", ("action", "", "short"), ("action", "", " longer"), ("action", "", "Longest"))).collect()
    assert [(r.action_seq, r.action) for r in got] == [(0, "longer"), (1, "Longest")]
    rows = page(spark, "row", ("authority", "", "0"), ("authority", "", "101"), ("authority", "", "33"), ("backlinks", "", "n/a"), ("backlinks", "", "1.5K"))
    rows = rows.select("client_id", "subject", F.lit(1).alias("row_seq"), F.array(F.lit("1"), F.lit("ref.example\nnew")).alias("cells"), "elements")
    assert only(C.referring_domain_rows(rows)) == {"client_id": "c", "subject": "s", "row_seq": 1, "ref_domain": "ref.example",
                                                   "authority_score": 33.0, "backlinks": 1500.0}
