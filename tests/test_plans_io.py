"""Plan shape checks, settings dimensions, sinks and the streaming path."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL

# queries whose plan may legitimately hold a JVM ML transformer UDF
ML_QUERIES = {"key_phrases", "topics"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_in_any_plan(spark):
    from marketlens.plans.registry import load_all
    for name, query in load_all().items():
        if name == "topics":
            continue
        plan = _plan(query.build(spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_dimensions_are_broadcast(spark):
    import __spark_entry__ as E
    q = E.queries()
    assert "BroadcastExchange" in _plan(q["projection_monthly"](spark, SF_SMALL))  # curves
    assert "BroadcastExchange" in _plan(q["geo"](spark, SF_SMALL))                 # nation/region
    assert "NestedLoop" not in _plan(q["related_keywords"](spark, SF_SMALL))


def test_scan_prunes_columns(spark):
    import __spark_entry__ as E
    plan = E.queries()["complaint_ranking"](spark, SF_SMALL)
    txt = _plan(plan)
    assert "ReadSchema: struct<doc_id:bigint,text:string,source:string>" in txt or "n_chars" not in txt


def test_settings_dimensions(spark, tmp_path):
    from marketlens.sources import settings as S
    docs = [{"client_id": "a", "target": {"name": "Acme", "domain": "acme.com"},
             "competitors": [{"domain": "b.com", "name": "B", "priority": "primary"},
                             {"domain": "", "name": "Empty"}, {"domain": "c.com"}],
             "market_keywords": ["k1", "k2"], "projections": {"monthly_ad_spend": 100.0}},
            {"client_id": "z", "target": {"domain": ""}}]
    for d in docs:
        (tmp_path / f"{d['client_id']}.json").write_text(json.dumps(d, indent=2))
    st = S.read_settings(spark, str(tmp_path), multi_line=True)
    dom = sorted((r.client_id, r.seq, r.domain) for r in S.all_domains(st).collect())
    assert dom == [("a", 0, "acme.com"), ("a", 1, "b.com"), ("a", 3, "c.com")]
    assert [r.domain for r in S.primary_competitors(S.competitors(st)).collect()] == ["b.com"]
    names = {r.domain: r.name for r in S.competitor_names(S.competitors(st)).collect()}
    assert names["c.com"] is None and names["b.com"] == "B"
    sc = {r.scenario_id: r for r in S.scenarios(st).collect()}
    assert sc["a"].monthly_ad_spend == 100.0 and sc["z"].aov == 100.0 and sc["z"].months == 6
    locs = sorted(r.location for r in S.review_locations(st).filter("client_id = 'a'").collect())
    assert locs == ["Los Angeles", "New York"]
    assert S.read_benchmark(spark, str(tmp_path / "missing.json")).collect()[0].avg_cpc is None


def test_sinks_round_trip(spark, tmp_path):
    from marketlens.sources import sinks as K
    df = spark.createDataFrame([("c1", "x", [1, 2]), ("c2", "y", [3]), ("", "z", [])],
                               "client_id string, v string, arr array<int>")
    out = str(tmp_path / "out")
    K.write_csv(df, out + "/csv")
    back = spark.read.option("header", True).csv(out + "/csv")
    assert sorted(r.arr for r in back.collect()) == ["[1,2]", "[3]", "[]"]
    written, manifest = K.export_dashboard({"kw": df, "bl": df.limit(1)}, ["kw", "nope", "bl"], out + "/dash")
    assert len(written) == 2
    m = {r.client_id: [f.dataset for f in r.files] for r in manifest.collect()}
    assert "" not in m and m["c1"] == ["bl", "kw"]
    assert os.path.isdir(out + "/dash/kw/client_id=c1")
    assert K.save_reviews(df.filter("false"), out + "/rev") == []
    r = K.read_reviews(spark, json_path=str(tmp_path / "none.json"), csv_path=str(tmp_path / "none.csv"))
    assert r is None


def test_streaming_windowed_complaints(spark, tmp_path):
    from marketlens.streaming.reviews_stream import review_stream, start_to_memory, windowed_complaints
    src = tmp_path / "in"
    src.mkdir()
    recs = [{"review_seq": 1, "brand": "b", "location": "x", "scraped_at": "2024-01-01T10:00:00",
             "rating": 1, "text": "rude staff everywhere", "reviewer": "a", "date": "d"},
            {"review_seq": 2, "brand": "b", "location": "x", "scraped_at": "2024-01-01T11:00:00",
             "rating": 5, "text": "great experience overall", "reviewer": "a", "date": "d"}]
    (src / "part-0.json").write_text("\n".join(json.dumps(r) for r in recs))
    q = start_to_memory(windowed_complaints(review_stream(spark, str(src))), "wc_test", str(tmp_path / "ck"))
    try:
        q.processAllAvailable()
        got = {r.category: r.n_reviews for r in spark.sql("select * from wc_test").collect()}
    finally:
        q.stop()
    assert got == {"customer_service": 1}


def test_keyword_sink_with_competitors(spark, tmp_path):
    from marketlens.sources import sinks as K
    ranked = spark.createDataFrame([("b", 5.0, 1.0, 0.5, "T", 1, 2), ("a", 9.0, 0.0, 0.0, "Unknown", 1, 1)],
                                   "keyword string, volume double, kd double, cpc double, intent string, "
                                   "first_rank int, first_seq long")
    comps = spark.createDataFrame([("x.com", None, None), ("y.com", "Y", "primary")],
                                  "domain string, name string, priority string")
    paths = K.save_keywords(ranked, str(tmp_path), comps)
    csv = spark.read.option("header", True).csv(paths[1]).collect()
    assert [r.Keyword for r in csv] == ["a", "b"]
    c = {r.domain: (r.name, r.priority) for r in spark.read.json(paths[2]).collect()}
    assert c == {"x.com": ("x.com", "secondary"), "y.com": ("Y", "primary")}


def test_projection_sink_and_manifest_stamp(spark, tmp_path):
    from marketlens.operators import projections as G
    from marketlens.sources import sinks as K
    sc = spark.createDataFrame([(7, "luxury_ecommerce", 5000.0, 100.0, None, None, 2)],
                               "scenario_id long, industry string, monthly_ad_spend double, aov double, "
                               "cpc double, conversion_rate double, months int")
    m = G.monthly_projection(sc, G.default_curves(spark))
    paths = K.save_projections(m, G.projection_summary(m), str(tmp_path), inputs=G.resolve_inputs(sc),
                               as_of="2025-01-01 00:00:00")
    inp = spark.read.json(paths[0]).collect()[0]
    assert inp.base_cpc == 2.5 and inp.base_cr == 1.5 and inp.generated_at.startswith("2025-01-01")
    csv = spark.read.option("header", True).csv(paths[-1])
    assert len(csv.columns) == 17 and csv.count() == 2
    df = spark.createDataFrame([("c1", 1)], "client_id string, v int")
    _, man = K.export_dashboard({"d": df}, ["d"], str(tmp_path / "dash"), as_of="2025-01-01 00:00:00")
    assert str(man.collect()[0].generated_at).startswith("2025-01-01")


def test_remaining_sinks_round_trip(spark, tmp_path):
    from marketlens.sources import sinks as K
    out = str(tmp_path)
    ov = spark.createDataFrame([("a.com", 3, 2, None)], "target_host string, total_backlinks long, "
                               "referring_domains long, follow_links long")
    p = K.save_backlinks(ov, out)
    summ = spark.read.option("header", True).csv(p[1]).collect()[0]
    assert summ.domain == "a.com" and summ.follow_links == "0" and summ.image_links == "0"
    avg = spark.createDataFrame([(1.5,)], "avg_cpc double")
    top = spark.createDataFrame([("d", "kw", 1)], "domain string, keyword string, position int")
    assert len(K.save_paid(avg, top, top, out)) == 3
    neg = spark.createDataFrame([(1, "txt", ["price_value", "other"])],
                                "review_seq long, text string, categories array<string>")
    p = K.save_sentiment({"top_complaints": avg}, neg, out)
    assert spark.read.option("header", True).csv(p[-1]).collect()[0].categories == '["price_value","other"]'
    p = K.save_visibility({"prompts": top}, out)
    assert spark.read.json(p[0]).count() == 1
    rev = spark.createDataFrame([(1, "b", "long enough text")], "review_seq long, brand string, text string")
    p = K.save_reviews(rev, out)
    assert len(p) == 2
    back = K.read_reviews(spark, json_path=p[1])
    assert back.collect()[0].text == "long enough text"


def test_json_lines_of_many_rows_and_files_come_back(spark, tmp_path):
    from marketlens.sources import settings as S
    from marketlens.sources import sinks as K
    rows = [(i, "b", "x", None, 3, f"review text {i}", "r", "d") for i in range(60)]
    p = K.save_reviews(spark.createDataFrame(rows, K.REVIEW_SCHEMA).repartition(3), str(tmp_path / "rev"))
    assert sorted(r.review_seq for r in K.read_reviews(spark, json_path=p[1]).collect()) == list(range(60))
    (tmp_path / "clients.json").write_text("".join(f'{{"client_id": "c{i}"}}\n' for i in range(5)))
    assert S.read_settings(spark, str(tmp_path / "clients.json")).count() == 5


def test_export_of_one_client_leaves_the_others(spark, tmp_path):
    from marketlens.sources import sinks as K
    out = str(tmp_path / "kw")
    both = spark.createDataFrame([("a", 1), ("b", 2)], "client_id string, v int")
    K.write_json(both, out, ("client_id",))
    K.write_json(both.where("client_id = 'a'").selectExpr("client_id", "v + 10 as v"), out, ("client_id",))
    assert sorted((r.client_id, r.v) for r in spark.read.json(out).collect()) == [("a", 11), ("b", 2)]


def test_written_benchmark_is_used(spark, tmp_path):
    from marketlens.sources import settings as S
    from marketlens.sources import sinks as K
    averages = spark.createDataFrame([("a", 9.49), ("b", 1.5)], "client_id string, avg_cpc double")
    K.write_json(averages, str(tmp_path / "avg"))
    assert sorted((r.client_id, r.avg_cpc) for r in S.read_benchmark(spark, str(tmp_path / "avg")).collect()) == [("a", 9.49), ("b", 1.5)]
