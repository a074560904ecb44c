"""Top-k set similarity, substring hits and exact medians against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from marketlens.operators import joins, quantiles, similarity
from marketlens.operators.keywords import top_organic_competitors


def closest(sets, targets, k):
    out = []
    for t in targets:
        own = sets.get(t, set())
        scored = [(-len(own & other) / len(own | other), s, len(own & other)) for s, other in sets.items() if s != t and own & other]
        out += [(t, s, n, round(-score, 9), r) for r, (score, s, n) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def families(seed=1):
    """Copies, subsets and strangers; one item that every set holds."""
    rng = random.Random(seed)
    sets = {}
    for f in range(12):
        base = [f"i{rng.randrange(400)}" for _ in range(rng.randint(1, 60))]
        for c, share in enumerate((1, 1, 0.9, 0.6, 0.3, 0.1)):
            sets[f"s{f}-{c}"] = {x for x in base if rng.random() < share} | {"everywhere"}
    return sets | {"alone": {"only this"}, "pair-a": {"x", "y"}, "pair-b": {"x", "z"}}


@pytest.mark.parametrize("k, hot_sets", [(1, similarity.HOT_SETS), (5, 7), (40, 7)])
def test_top_k_similar_equals_brute_force(spark, k, hot_sets):
    sets = families()
    rows = [(s, x) for s, items in sets.items() for x in items]
    members = spark.createDataFrame(rows + rows[:30] + [(None, "x"), ("s0-0", None)], "set_id string, item string")
    targets = ["s0-0", "s3-2", "s7-5", "alone", "pair-a", "unknown"]
    got = similarity.top_k_similar(members, spark.createDataFrame([(t,) for t in targets + ["s0-0", None]], "target string"), k, hot_sets=hot_sets)
    assert sorted((r.target, r.set_id, r.shared, round(r.score, 9), r["rank"]) for r in got.collect()) == closest(sets, targets, k)


def test_hot_items_are_dealt_over_several_tasks(spark):
    members = spark.createDataFrame([(f"s{k}", "hot") for k in range(500)] + [(f"s{k}", f"i{k}") for k in range(500)], "set_id string, item string")
    df = members.groupBy("item").agg(F.count("*").alias("df"))
    hot = similarity.hot_items(df, 1000, 50)
    assert [(r["item"], r.salts) for r in hot.collect()] == [("hot", 10)]
    met = similarity.join_items(members, spark.createDataFrame([("t", "hot")], "target string, item string"), hot)
    assert met.count() == 500
    left = met._jdf.queryExecution().optimizedPlan().toString()
    assert "salt" in left


def test_one_target_of_two_clients(spark):
    kw = spark.createDataFrame([("a.com", "x"), ("b.com", "x"), ("b.com", "y")], "domain string, keyword string")
    t = spark.createDataFrame([("c1", "a.com"), ("c2", "a.com")], "client_id string, target string")
    got = top_organic_competitors(kw, t).collect()
    assert sorted((r.client_id, r.domain, r.shared, r.score, r["rank"]) for r in got) == [("c1", "b.com", 1, 0.5, 1), ("c2", "b.com", 1, 0.5, 1)]
    assert top_organic_competitors(kw.limit(0), t).collect() == []


@pytest.mark.parametrize("block", [joins.BLOCK, 5])
def test_pattern_hits_equal_substring_test(spark, block):
    texts = ["the cat sat", "concatenate", "", None, "aaaaaa", "ÑANDÚ ñandú 日本語 😀x", "cat", "cat", "a", "old gear", "x" * 5000 + "cat"]
    patterns = ["cat", "at s", "aaa", "ñandú", "😀", "日本語", "", None, "cold gear", "zzzz", "concatenates", "t", "cat", "xcat", "old gear"]
    got = joins.pattern_hits(spark.createDataFrame(list(enumerate(texts)), "id int, t string"),
                             spark.createDataFrame([(p,) for p in patterns], "p string"), "t", "p", block=block)
    want = sorted((i, p) for i, t in enumerate(texts) for p in {x for x in patterns if x} if t and p in t)
    assert sorted((r.id, r.p) for r in got.collect()) == want
    none = joins.pattern_hits(spark.createDataFrame([("a",)], "t string"), spark.createDataFrame([("",)], "p string"), "t", "p")
    assert none.columns == ["t", "p"] and none.collect() == []


def test_frequent_grams_give_no_candidates(spark):
    """Every gram of the pattern is in every text, the pattern in none: what
    leaves the texts' tasks is counts, and no hit."""
    texts = spark.range(300).select(F.concat_ws(" ", F.lit("abcde bcdef cdefg defgh"), "id").alias("t"))
    got = joins.pattern_hits(texts, spark.createDataFrame([("abcdefgh",)], "p string"), "t", "p")
    assert got.count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [t" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("ranges, few", [(4096, 65_536), (8, 1), (2, 1)])
def test_upper_median_equals_sorting(spark, ranges, few):
    rng = random.Random(5)
    groups = {"one": [3.5], "two": [1.0, 2.0], "same": [7.25] * 9, "ties": [1.0] * 5 + [2.0] * 5, "wide": [10.0 ** rng.uniform(-9, 9) for _ in range(301)],
              "money": [round(rng.uniform(0, 20), 2) for _ in range(400)], None: [-1.5, 0.0, -1e300, 1e300], "none": []}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("none", None), ("two", None)]
    counts = spark.createDataFrame(rows, "g string, v double").groupBy("g", "v").agg(F.count("*").alias("n"))
    got = {r.g: r.median for r in quantiles.upper_median(counts, ["g"], "v", "n", ranges=ranges, few=few).collect()}
    assert got == {g: sorted(vs)[len(vs) // 2] for g, vs in groups.items() if vs}
    total = counts.groupBy("v").agg(F.sum("n").alias("n"))
    every = sorted(v for vs in groups.values() for v in vs)
    assert [r.m for r in quantiles.upper_median(total, [], "v", "n", "m", ranges, few).collect()] == [every[len(every) // 2]]
    assert quantiles.upper_median(counts.limit(0), ["g"], "v", "n").collect() == []


@pytest.mark.parametrize("k", [1, 5, 40])
@pytest.mark.parametrize("few", [similarity.FEW_SETS, 0])
def test_few_sets_are_counted_item_by_item(spark, monkeypatch, k, few):
    """The same rows as by the prefix filter, of which no round is run."""
    sets, calls = families(2), []
    monkeypatch.setattr(similarity, "join_items", lambda *a, real=similarity.join_items: calls.append(1) or real(*a))
    rows = [(s, x) for s, items in sets.items() for x in items]
    members = spark.createDataFrame(rows + rows[:30] + [(None, "x"), ("s0-0", None)], "set_id string, item string")
    targets = spark.createDataFrame([(t,) for t in ["s0-0", "s3-2", "alone", "pair-a", "unknown", "s0-0", None]], "target string")
    got = similarity.top_k_similar(members, targets, k, few_sets=few).collect()
    assert sorted((r.target, r.set_id, r.shared, round(r.score, 9), r["rank"]) for r in got) == closest(sets, ["s0-0", "s3-2", "alone", "pair-a"], k)
    assert bool(calls) == (few == 0)


def test_patterns_that_no_text_can_hold_cost_no_pass(spark):
    """The texts are read once to count, not once for each block of patterns."""
    texts = spark.createDataFrame([("brand of the year",), ("a brand 7 item",)], "t string")
    patterns = spark.range(200).select(F.concat(F.lit("Brand "), "id").alias("p"))
    got = joins.pattern_hits(texts, patterns, "t", "p", block=5)
    assert got.collect() == [] and "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()
    low = joins.pattern_hits(texts, patterns.select(F.lower("p").alias("p")), "t", "p", block=5)
    assert [tuple(r) for r in low.collect()] == [("a brand 7 item", "brand 7")]
    assert low._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 1
