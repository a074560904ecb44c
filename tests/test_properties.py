"""Properties and edge cases from the test strategy."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from marketlens.operators import projections as G
from marketlens.operators import reviews as R
from marketlens.operators import visibility as V
from tests.conftest import SF_SMALL

Q = E.queries()


def test_category_counts_cover_every_negative(spark):
    c = Q["complaint_counts"](spark, SF_SMALL).collect()
    total = c[0].total_negative
    assert sum(r.n_reviews for r in c) >= total > 0
    assert sorted(r.rank for r in c) == list(range(1, len(c) + 1))


def test_trigger_classes_total_and_disjoint(spark):
    cls = Q["trigger_classes"](spark, SF_SMALL)
    n_docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert cls.count() == n_docs == cls.select("doc_id").distinct().count()
    counts = Q["trigger_counts"](spark, SF_SMALL).collect()
    assert len(counts) == 5 and sum(r.n_keywords for r in counts) == n_docs


def test_prompt_counts_rollup_consistent(spark):
    pc = Q["prompt_counts"](spark, SF_SMALL).collect()
    per_client = {}
    for r in pc:
        if r.client_id is not None and r.category is not None:
            per_client[r.client_id] = per_client.get(r.client_id, 0) + r.n_prompts
    totals = {r.client_id: r.n_prompts for r in pc if r.client_id is not None and r.category is None}
    assert per_client == totals
    grand = [r.n_prompts for r in pc if r.client_id is None]
    assert grand == [sum(totals.values())]


def test_backlink_gap_excludes_target_referrers(spark):
    from marketlens.operators import links as L
    from marketlens.plans.q_links import backlink_roles
    from marketlens.sources.fixtures import links_df
    from marketlens.sources.tables import Tables
    facts = L.normalise_link_facts(links_df(Tables(spark, SF_SMALL)))
    roles = backlink_roles(facts)
    targets = {r.client_id: r.domain for r in roles.filter("seq = 0").collect()}
    gap = {(r.client_id, r.ref_host) for r in L.backlink_gap(facts, roles).collect()}
    linked = {(r.target_host, r.src_host) for r in facts.filter(F.col("src_host") != F.col("target_host")).collect()}
    assert gap and not [g for g in gap if (targets[g[0]], g[1]) in linked]


def test_empty_negatives(spark):
    empty = spark.createDataFrame([], "review_seq long, brand string, location string, text string, rating int")
    neg = R.filter_negative(R.score_reviews(empty))
    assert R.top_complaints(neg).count() == 0
    assert R.complaint_samples(neg).count() == 0


def test_short_horizons_and_zero_spend(spark):
    sc = spark.createDataFrame([(1, "luxury_ecommerce", 0.0, 90.0, 2.0, 2.0, 1),
                                (2, "luxury_ecommerce", 1000.0, 90.0, 2.0, 2.0, 2)],
                               "scenario_id long, industry string, monthly_ad_spend double, aov double, "
                               "cpc double, conversion_rate double, months int")
    m = G.monthly_projection(sc, G.default_curves(spark))
    s = {(r.scenario_id, r.horizon): r for r in G.projection_summary(m).collect()}
    # zero spend: ROAS and CAC guarded to 0
    assert s[(1, "6_month")].roas == 0.0 and s[(1, "6_month")].avg_cac == 0.0
    # fewer than three months: organic share 0 for '3_month', last month for '6_month'
    assert s[(2, "3_month")].organic_traffic_pct == 0.0
    assert s[(2, "6_month")].organic_traffic_pct == 7.0


def test_brand_mentions_counts(spark):
    conv = spark.createDataFrame([(1, 0, "user", "who sells candles?"),
                                  (1, 1, "assistant", "Acme and acme.com sell them; also BetaCo."),
                                  (2, 1, "assistant", "Try BetaCo")],
                                 "conv_id long, turn long, role string, text string")
    brands = spark.createDataFrame([("c", "Acme"), ("c", "BetaCo"), ("c", "Zed")], "client_id string, brand string")
    got = {r.brand: (r.answers_mentioning, r.mentions, r.share_of_voice, r.prompts_tracked)
           for r in V.brand_mentions(conv, brands).collect()}
    assert got == {"Acme": (1, 2, 0.333333, 1), "BetaCo": (2, 2, 0.666667, 1), "Zed": (0, 0, 0.0, 1)}


def test_contains_pairs_equals_substring_test(spark):
    from marketlens.operators.joins import contains_pairs
    texts = ["abc", "xbcx", "zzz", "", None, "brand 12 and\nbrand 123", "Straße \U0001f600brand\U0001f600", "abc"]
    pats = ["bc", "z", "q", "a", "", None, "brand 1", "brand 12", "brand 123", "brand 13", "and\nb", "\U0001f600b", "ße \U0001f600br", "bc"]
    got = contains_pairs(spark.createDataFrame([(t,) for t in texts], "t string"),
                         spark.createDataFrame([(p,) for p in pats], "p string"), "t", "p")
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    want = {(t, p) for t in texts if t is not None for p in pats if p and p in t}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_prompt_texts_literal(spark):
    t = spark.createDataFrame([("c", "Acme")], "client_id string, target_name string")
    kw = spark.createDataFrame([("c", i, f"kw{i}") for i in range(1, 7)], "client_id string, seq int, keyword string")
    cp = spark.createDataFrame([("c", i, f"C{i}") for i in range(1, 5)], "client_id string, seq int, name string")
    p = V.build_prompts(t, kw, cp)
    rows = sorted((r.cat_order, r.item_seq, r.tpl_order, r.prompt) for r in p.collect())
    prompts = [r[3] for r in rows]
    assert prompts[:4] == ["What is Acme?", "Tell me about Acme", "Is Acme reliable?", "Acme reviews"]
    assert prompts[4:6] == ["What are the best kw1 companies?", "Who offers kw1?"]
    assert "Is C3 or Acme better?" in prompts and "Acme vs C4" not in prompts
    assert "How much does kw5 cost?" in prompts and "How does kw6 work?" not in prompts
    counts = {}
    for r in rows:
        counts[r[0]] = counts.get(r[0], 0) + 1
    assert counts == {1: 4, 2: 10, 3: 6, 4: 6, 5: 5, 6: 5}


def test_links_of_every_spelling(spark):
    from marketlens.operators import links as L
    html = ("<a href='/x'>one</a><A HREF=\"HTTPS://B.example/p?q\" rel='NoFollow me'><IMG src=i></A><a href=//c.example/y>two</a>"
            "<a href='mailto:me@d.example'>mail</a><a name=top>none</a><a data-href=\"http://e.example/\" href=z>three</a>")
    got = L.extract_links(spark.createDataFrame([(1, "http://a.example/", html), (2, "http://a.example/", None)],
                                                "page_id long, url string, html string"))
    rows = [(r.target_host, r.target_path, r.nofollow, r.has_img) for r in got.orderBy("link_pos").collect()]
    assert rows == [("a.example", "/x", False, False), ("b.example", "/p?q", True, True), ("c.example", "/y", False, False),
                    (None, "mailto:me@d.example", False, False), (None, "", False, False), ("a.example", "z", False, False)]
