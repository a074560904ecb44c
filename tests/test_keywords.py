"""Keyword merge / gap properties."""

import random

import pytest
from pyspark.sql import functions as F

from marketlens.operators import keywords as K

OBS = "seq long, source_rank int, keyword string, volume_raw string, kd_raw string, cpc_raw string, " \
      "intent_raw string, domain string"


def test_market_last_wins_later_first_wins(spark):
    obs = spark.createDataFrame([
        (1, 1, "Car Shipping", "10K", "40", "$2", "T", "m"),
        (2, 1, "car shipping", "20K", "41", "$3", "C", "m"),    # market dup: last wins
        (3, 2, "car shipping", "99K", "1", "$9", "I", "s"),     # later source never overrides
        (4, 2, "auto transport", "5K", "30", "$1", "N", "s"),
        (5, 3, "auto transport", "6K", "31", "$1", "N", "s")], OBS)
    m = {r.keyword: r for r in K.merge_keywords(K.parse_metrics(obs)).collect()}
    assert m["car shipping"].volume == 20000 and m["car shipping"].intent == "Commercial"
    assert (m["car shipping"].first_rank, m["car shipping"].first_seq) == (1, 1)
    assert m["auto transport"].volume == 5000


def test_merge_invariant_under_repartition(spark):
    from marketlens.sources.fixtures import keyword_obs_df
    from marketlens.sources.tables import Tables
    from tests.conftest import SF_SMALL
    obs = keyword_obs_df(Tables(spark, SF_SMALL))
    a = sorted(map(tuple, K.merge_keywords(K.parse_metrics(obs)).collect()))
    b = sorted(map(tuple, K.merge_keywords(K.parse_metrics(obs.repartition(7, "seq"))).collect()))
    assert a == b


def test_gap_sets_partition_universe(spark):
    kw = spark.createDataFrame([("t.com", "a", 1), ("t.com", "b", 2), ("c1.com", "b", 1), ("c1.com", "c", 3),
                                ("c2.com", "c", 1), ("c2.com", "d", 2), ("x.com", "z", 1)],
                               "domain string, keyword string, position int")
    roles = spark.createDataFrame([("k", 0, "t.com"), ("k", 1, "c1.com"), ("k", 2, "c2.com")],
                                  "client_id string, seq int, domain string")
    g = {r.keyword: (r.status, r.n_competitors, r.best_position) for r in K.domain_keyword_gap(kw, roles).collect()}
    assert g == {"a": ("unique", 0, None), "b": ("shared", 1, 1), "c": ("missing", 2, 1), "d": ("missing", 1, 2)}


def test_related_keywords(spark):
    seeds = spark.createDataFrame([(1, "Car")], "seed_seq int, seed string")
    uni = spark.createDataFrame([("car", 1.0), ("car hire", 5.0), ("scar", 2.0), ("bus", 9.0)],
                                "keyword string, volume double")
    got = [(r.keyword, r.rank) for r in K.related_keywords(seeds, uni).orderBy("rank").collect()]
    assert got == [("car hire", 1), ("scar", 2)]   # substring, not token; the seed itself excluded


def test_global_rank_matches_window(spark):
    from pyspark.sql import Window as W
    from marketlens.operators.ranking import global_row_number
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), F.col("id"))
    got = {r.id: r.rank for r in global_row_number(df, [F.desc("k"), F.asc("id")], num_partitions=5).collect()}
    want = {r.id: r.rank for r in df.withColumn("rank", F.row_number().over(W.orderBy(F.desc("k"), "id"))).collect()}
    assert got == want


def test_grouped_rank_matches_window_with_hot_group(spark):
    from pyspark.sql import Window as W
    from marketlens.operators.ranking import grouped_row_number
    # group 0 holds half of all rows
    df = spark.range(0, 6000).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 7).alias("g"),
        (F.col("id") * 7919 % 6000).alias("v"), F.col("id"))
    got = {r.id: r.position for r in grouped_row_number(df, ["g"], [F.desc("v"), F.asc("id")],
                                                        num_partitions=6).collect()}
    want = {r.id: r.p for r in df.withColumn(
        "p", F.row_number().over(W.partitionBy("g").orderBy(F.desc("v"), "id"))).collect()}
    assert got == want


def test_first_competitors_after_the_filter(spark):
    from marketlens.operators.keywords import first_competitors
    roles = spark.createDataFrame([("c", 0, "t")] + [("c", s, f"d{s}") for s in (3, 4, 5, 6, 7)], "client_id string, seq int, domain string")
    assert sorted(r.seq for r in first_competitors(roles, k=4).collect()) == [0, 3, 4, 5, 6]
    assert first_competitors(roles).count() == 6


def test_many_clients_equal_each_alone(spark):
    """A job over all clients gives each the rows that it gets alone."""
    from marketlens.operators import dashboard as D
    from marketlens.operators import paid as P
    from marketlens.operators import visibility as V
    rows = [(i % 3, i, i % 5 + 1, f"kw {i % 4}", f"{i}K", "40", f"${i}.5", "T", f"d{i % 2}") for i in range(60)]
    obs = spark.createDataFrame([(f"c{c}", *r) for c, *r in rows], "client_id string, " + OBS)
    caps = {2: (1, 2), 3: (1, None)}

    def merged(o, by):
        return K.merge_keywords(K.parse_metrics(K.cap_sources(o, caps, by)), by=by)

    def related(o, by):
        seeds = o.groupBy(*by, F.substring("keyword", 1, 3).alias("seed")).agg(F.min("seq").alias("seed_seq"))
        return K.related_keywords(seeds, merged(o, by).select(*by, "keyword", "volume"), by=by)

    def averages(o, by):
        look = P.keyword_lookups(o.withColumn("competition_raw", F.lit("1")), 4, by)
        n = look.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
        return P.industry_averages(P.cpc_pool(look, look, by), n, n.withColumnRenamed("n", "m"), by)

    def advice(o, by):
        return V.recommendations(V.classify_triggers(o), "seq", "keyword", by)

    for job in (merged, related, averages, advice, lambda o, by: K.keyword_coverage(merged(o, by), by),
                lambda o, by: D.keyword_map(K.parse_metrics(o), by)):
        together = job(obs, ("client_id",))
        for c in ("c0", "c1", "c2"):
            alone = job(obs.filter(F.col("client_id") == c), ())
            cols = alone.columns
            got = sorted(map(str, together.filter(F.col("client_id") == c).select(*cols).collect()))
            assert got and got == sorted(map(str, alone.collect()))


@pytest.mark.parametrize("ranges,block", [(1, 4), (4, 16), (32, 1 << 20)])
def test_value_row_number_is_the_plain_window(spark, ranges, block):
    """Two values hold most of a group, values and group names are null, and
    some groups are small; nothing is checkpointed."""
    from pyspark.sql import Window as W
    from pyspark.sql import functions as F

    from marketlens.operators.ranking import value_row_number
    rng = random.Random(7)
    rows = []
    for i in range(1500):
        client = rng.choice(["a", "a", "a", "b", None]) if i != 3 else "single"
        volume = rng.choice([0.0, 0.0, 0.0, 90.5, None, float(rng.randint(1, 400))])
        rows.append((client, volume, rng.randint(1, 5), i))
    rows += [("none", None, 1, 10_000), ("none", None, 1, 10_001)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "client_id string, volume double, first_rank int, first_seq long")
    plain = F.row_number().over(W.partitionBy("client_id").orderBy(F.desc_nulls_last("volume"), "first_rank", "first_seq"))
    want = {r.first_seq: r.n for r in df.withColumn("n", plain).collect()}
    ranked = value_row_number(df, ["client_id"], "volume", ["first_rank"], "first_seq", ranges=ranges, block=block)
    got = [(r.first_seq, r["rank"]) for r in ranked.collect()]
    assert len(got) == len(rows) and dict(got) == want
    assert ranked.columns == [*df.columns, "rank"]
    assert value_row_number(df.limit(0), ["client_id"], "volume", ["first_rank"], "first_seq").count() == 0


def test_gap_page_is_capped_per_client(spark):
    """The gap is one page: its limit counts the rows of a client, not those of a domain."""
    rows = [(c, s, 5, f"k{s}", f"d{s % 4}") for c in ("a", "b") for s in range(1, 13)] + [("a", 99, 1, "m", "d1")]
    obs = spark.createDataFrame(rows, "client_id string, seq long, source_rank int, keyword string, domain string")
    left = K.cap_sources(obs, {5: (None, None, 5)}, ("client_id",))
    assert sorted((r.client_id, r.seq) for r in left.collect()) == sorted(
        [(c, s) for c in ("a", "b") for s in range(1, 6)] + [("a", 99)])
    assert left.columns == ["client_id", "source_rank", "domain", "seq", "keyword"]
    per_domain = K.cap_sources(obs, {5: (None, 2, None)}, ("client_id",))
    assert per_domain.filter("source_rank = 5").count() == 2 * 4 * 2
