"""Readers that keep what they can't read, payload documents, exports."""

import json

import pytest
from pyspark.sql import functions as F

from marketlens.operators import dashboard as D
from marketlens.operators import visibility as V
from marketlens.sources import settings as S
from marketlens.sources import sinks as K


def test_bad_lines_are_kept_apart(spark, tmp_path):
    good = [{"client_id": f"c{k}", "market_keywords": ["a"], "unknown": k} for k in range(5)]
    bad = ['{"client_id": "x", ', '{"client_id": "y", "competitors": "none"}', "5", '"text"', "null", "[1]", "not json",
           '{"client_id": "z", "market_keywords": [{"a": 1}], "projections": {"months": "six"}}']
    (tmp_path / "a.json").write_text("\n".join([json.dumps(g) for g in good[:3]] + ["", "   "] + bad[:4]) + "\n")
    (tmp_path / "b.json").write_text("\n".join(bad[4:] + [json.dumps(g) for g in good[3:]]))
    path = str(tmp_path)
    assert sorted(r.client_id for r in S.read_settings(spark, path).collect()) == [g["client_id"] for g in good]
    rejected = S.rejected_settings(spark, path).collect()
    assert sorted(r.document for r in rejected) == sorted(bad)
    assert {r.file.rsplit("/", 1)[1] for r in rejected} == {"a.json", "b.json"}


def test_whole_documents_and_arrays(spark, tmp_path):
    (tmp_path / "one.json").write_text('{\n "client_id": "a"\n}')
    (tmp_path / "many.json").write_text('[{"client_id": "b"},\n {"client_id": "c", "competitors": 7}, {"client_id": "d"}]')
    (tmp_path / "bad.json").write_text('{"client_id": "e"')
    assert sorted(r.client_id for r in S.read_settings(spark, str(tmp_path), multi_line=True).collect()) == ["a", "b", "d"]
    assert len(S.rejected_settings(spark, str(tmp_path), multi_line=True).collect()) == 2


def test_csv_records_that_do_not_fit(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text('review_seq,brand,location,scraped_at,rating,text,reviewer,date\n'
                 '1,b,x,2024-01-01 10:00:00,5,"good, ""very""\ngood",r,d\n2,b,x,,five,text,r,d\n3,b,x,,4,ok,r,d\n')
    good, bad = K.read_reviews_checked(spark, csv_path=str(p))
    assert sorted((r.review_seq, r.text) for r in good.collect()) == [(1, 'good, "very"\ngood'), (3, "ok")]
    [row] = bad.collect()
    assert row.document.startswith("2,b,x") and row.file.endswith("r.csv")
    assert K.read_reviews(spark, json_path=str(tmp_path / "none")) is None
    flat = tmp_path / "flat.csv"
    flat.write_text("review_seq,brand,location,scraped_at,rating,text,reviewer,date\n1,b,x,,5,t,r,d\n")
    assert K.read_reviews(spark, csv_path=str(flat), quoted_lines=False).count() == 1


@pytest.fixture
def clients(spark):
    return spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("", 4), (None, 5)], "client_id string, v int")


def entries_of(spark, out):
    return {r.client_id: (r.version, [(f.dataset, f.rows) for f in r.files]) for r in K.read_manifest(spark, out).collect()}


def test_manifest_is_merged_by_client(spark, clients, tmp_path):
    out = str(tmp_path)
    assert K.read_manifest(spark, out).collect() == []
    K.export_dashboard({"kw": clients, "bl": clients}, ["kw", "bl"], out)
    K.export_dashboard({"kw": clients.filter("client_id = 'a' and v = 1")}, ["kw"], out)
    assert entries_of(spark, out) == {"a": (2, [("kw", 1)]), "b": (1, [("bl", 1), ("kw", 1)])}
    assert sorted(r.v for r in spark.read.json(out + "/kw").collect()) == [1, 3]


def test_failed_export_leaves_everything(spark, clients, tmp_path):
    out = str(tmp_path)
    K.export_dashboard({"kw": clients}, ["kw"], out)
    fails = clients.withColumn("v", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        K.export_dashboard({"kw": clients.filter("v = 1"), "bl": fails}, ["kw", "bl"], out)
    assert entries_of(spark, out) == {"a": (1, [("kw", 2)]), "b": (1, [("kw", 1)])}
    assert sorted(r.v for r in spark.read.json(out + "/kw").collect()) == [1, 2, 3]


def test_formats_and_alternates(spark, clients, tmp_path):
    written, manifest = K.export_dashboard(
        {"competitor_paid_summary": clients, "own": clients}, ["competitor_benchmarks", "own", "traffic_data"], str(tmp_path),
        formats=K.DASHBOARD_FORMATS, alternates=K.ALTERNATE_SOURCES)
    assert [w.rsplit("/", 1)[1] for w in written] == ["competitor_benchmarks"]
    assert {r.client_id for r in manifest.collect()} == {"a", "b"}
    assert K.export_dashboard({}, ["x"], str(tmp_path)) == ([], None)


def test_each_dataset_is_computed_once(spark, clients, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    K.export_dashboard({"kw": clients.mapInArrow(counted, clients.schema)}, ["kw"], str(tmp_path))
    assert seen.value == 5


KEYS = "client_id string, keyword string, volume double, kd double, cpc double, intent string"


def test_keyword_documents_are_split_and_ordered(spark):
    words = [("big", f"k{k:03d}", float(k), 1.0, 0.5, "Unknown") for k in range(250)] + [("small", "b", 1.0, 0.0, 0.0, "I"), ("small", "a", 2.0, 0.0, 0.0, "T")]
    rivals = spark.createDataFrame([("big", 1, "x.com", None, None), ("big", 2, "x.com", "X", "primary"), ("big", 3, "", "n", "p"), ("idle", 1, "y.com", None, None)],
                                   "client_id string, seq int, domain string, name string, priority string")
    gap = spark.createDataFrame([("small", 2, "g2", 9, 1), ("small", 1, "g1", 3, 2)], "client_id string, rank int, keyword string, best_position int, n_competitors int")
    docs = D.keyword_payload(spark.createDataFrame(words, KEYS), rivals, part_keywords=40, source="s", as_of="2025-01-01 00:00:00", gap=gap)
    assert all(r.k == sorted(r.k) for r in docs.select(F.map_keys("keywords").alias("k")).collect())
    docs = docs.collect()
    big = sorted((d for d in docs if d.client_id == "big"), key=lambda d: d.part)
    assert len(big) == 7 and {d.parts for d in big} == {7} and max(len(d.keywords) for d in big) < 80
    assert sorted(k for d in big for k in d.keywords) == [w[1] for w in words[:250]]
    assert [d.competitors for d in big][0] == {"x.com": ("X", "primary")} and all(not d.competitors for d in big[1:])
    [small] = [d for d in docs if d.client_id == "small"]
    assert sorted(small.keywords) == ["a", "b"] and small.keywords["a"].volume == 2.0 and [g.keyword for g in small.keyword_gap] == ["g1", "g2"]
    [idle] = [d for d in docs if d.client_id == "idle"]
    assert (idle.part, idle.parts, idle.keywords, idle.competitors, idle.keyword_gap) == (1, 1, {}, {"y.com": ("y.com", "secondary")}, [])


def test_backlink_documents(spark, tmp_path):
    roles = spark.createDataFrame([("c", 0, "t.com"), ("c", 1, "r.com"), ("c", 2, "none.com"), ("lone", 1, "r.com")], "client_id string, seq int, domain string")
    ov = spark.createDataFrame([("t.com", 5, 3, 4, 1, 10), ("r.com", 9, 2, 9, 0, 40)], "target_host string, total_backlinks long, referring_domains long, "
                               "follow_links long, nofollow_links long, authority_score long")
    pages = spark.createDataFrame([("t.com", f"/{k}", 1, 1, k) for k in range(1, 26)], "target_host string, target_path string, referring_domains long, backlinks long, rank int")
    none = pages.limit(0)
    profiles = D.backlink_profiles(roles, ov, pages, none.withColumnRenamed("target_path", "anchor"), none.withColumnRenamed("target_path", "ref_domain"))
    docs = {d.client_id: d for d in D.backlink_payload(profiles).collect()}
    c = docs["c"]
    assert c.target_domain == "t.com" and [(x.domain, x.is_target, x.authority_score) for x in c.comparison] == [
        ("r.com", False, 40.0), ("t.com", True, 10.0), ("none.com", False, 0.0)]
    assert [p.target_path for p in c.target_top_pages] == [f"/{k}" for k in range(1, 21)] and c.target_top_anchors == [] and c.comparison[2].total_backlinks == 0
    assert docs["lone"].target_domain == "" and docs["lone"].target_top_pages == []
    K.save_backlinks(ov, str(tmp_path), profiles)
    assert spark.read.json(str(tmp_path / "backlink_profiles_json")).filter("client_id = 'c'").count() == 3


def test_keyword_csv_of_lookups(spark, tmp_path):
    one = spark.createDataFrame([(1.5,)], "avg_cpc double")
    lookups = spark.createDataFrame([("c", "kw", "1K", None, "45%")], "client_id string, keyword string, volume_raw string, cpc_raw string, competition_raw string")
    paths = K.save_paid(one, one, one, str(tmp_path), lookups)
    [row] = spark.read.option("header", True).csv(paths[-1]).collect()
    assert (row.Keyword, row.Volume, row.CPC, row.Competition, row.client_id) == ("kw", "1K", None, "45%", "c")


def test_monthly_csv_of_one_client_leaves_the_others(spark, tmp_path):
    from marketlens.operators import projections as G
    sc = spark.createDataFrame([("a", 1, "luxury_ecommerce", 5000.0, 100.0, 1.0, 1.0, 2), ("b", 2, "luxury_ecommerce", 5000.0, 100.0, 1.0, 1.0, 3)],
                               "client_id string, scenario_id long, industry string, monthly_ad_spend double, aov double, cpc double, conversion_rate double, months int")
    m = G.monthly_projection(sc, G.default_curves(spark))
    if "client_id" not in m.columns:
        m = m.join(sc.select("scenario_id", "client_id"), "scenario_id")
    for part in (m, m.filter("client_id = 'a'")):
        path = K.save_projections(part, G.projection_summary(part), str(tmp_path))[-1]
    assert {r.client_id: r["count"] for r in spark.read.option("header", True).csv(path).groupBy("client_id").count().collect()} == {"a": 2, "b": 3}


def test_empty_prompt_categories(spark):
    targets = spark.createDataFrame([("c", "T"), ("quiet", "Q")], "client_id string, target_name string")
    kw = spark.createDataFrame([("c", 1, "kw")], "client_id string, seq int, keyword string")
    rivals = kw.limit(0).withColumnRenamed("keyword", "name")
    prompts = V.build_prompts(targets, kw, rivals)
    got = {(r.client_id, r.category): r.n_prompts for r in V.prompt_counts(prompts, clients=targets.select("client_id").union(spark.createDataFrame([("none",)], "c string"))).collect()}
    assert got["c", "comparison"] == 0 and got["quiet", "cost"] == 0 and got["quiet", "brand_direct"] == 4 and got["none", "brand_direct"] == 0
    assert got["c", None] == 10 and got["none", None] == 0 and got[None, None] == 14
