"""Projection goldens worked by hand from the source formulas."""

import pytest

from marketlens.operators import projections as G

SCEN = "scenario_id long, industry string, monthly_ad_spend double, aov double, cpc double, " \
       "conversion_rate double, months int"


def _run(spark, rows):
    sc = spark.createDataFrame(rows, SCEN)
    m = G.monthly_projection(sc, G.default_curves(spark))
    return m, G.projection_summary(m)


def test_scenario_a(spark):
    m, s = _run(spark, [(1, "luxury_ecommerce", 5000.0, 1100.0, None, 4.5, 6)])
    rows = {r.month: r for r in m.collect()}
    want_rev = [105773.68, 114407.47, 125888.89, 205676.47, 222643.47, 238596.04]
    for i, w in enumerate(want_rev, 1):
        assert rows[i].total_revenue == pytest.approx(w, abs=0.01)
    assert [rows[i].paid_traffic for i in range(1, 7)] == [2000, 2105, 2222, 2353, 2439, 2500]
    assert [rows[i].total_traffic for i in range(1, 7)] == [2105, 2264, 2469, 2674, 2869, 3049]
    assert rows[4].effective_cpc == pytest.approx(2.12, abs=0.01)
    assert rows[4].effective_cr == 6.75
    assert rows[1].cac == pytest.approx(52.0, abs=0.01)
    summ = {r.horizon: r for r in s.collect()}
    assert summ["3_month"].total_revenue == pytest.approx(346070.04, abs=0.02)
    assert summ["3_month"].total_orders == pytest.approx(314.6, abs=0.1)
    assert summ["6_month"].total_revenue == pytest.approx(1012986.02, abs=0.05)
    assert summ["6_month"].total_orders == pytest.approx(920.9, abs=0.1)
    assert summ["6_month"].roas == pytest.approx(33.77, abs=0.01)
    assert summ["6_month"].avg_cac == pytest.approx(32.58, abs=0.01)
    assert summ["3_month"].organic_traffic_pct == 10.0 and summ["3_month"].paid_traffic_pct == 90.0
    assert summ["6_month"].organic_traffic_pct == 18.0


def test_scenario_b(spark):
    m, s = _run(spark, [(2, "luxury_ecommerce", 5000.0, 65.0, None, None, 6)])
    rev = [r.total_revenue for r in sorted(m.collect(), key=lambda r: r.month)]
    assert rev == pytest.approx([2083.42, 2253.48, 2479.63, 4051.2, 4385.4, 4699.62], abs=0.01)
    summ = {r.horizon: r for r in s.collect()}
    assert summ["3_month"].total_revenue == pytest.approx(6816.53, abs=0.02)
    assert summ["6_month"].total_revenue == pytest.approx(19952.75, abs=0.05)
    assert summ["6_month"].roas == pytest.approx(0.67, abs=0.01)
    assert summ["6_month"].avg_cac == pytest.approx(97.72, abs=0.01)


def test_scenario_c_past_curve(spark):
    m, s = _run(spark, [(3, "luxury_ecommerce", 5000.0, 1100.0, None, 4.5, 13)])
    rows = {r.month: r for r in m.collect()}
    assert rows[12].effective_cpc == 1.8 and rows[12].total_revenue == pytest.approx(467500.0, abs=0.01)
    assert rows[13].effective_cpc == 1.88 and rows[13].organic_pct == 35.0
    assert rows[13].total_revenue == pytest.approx(448800.0, abs=0.01)
    assert rows[13].roas == pytest.approx(89.76, abs=0.01)
    # '6_month' totals cover all 13 months; organic share of month 6
    summ = {r.horizon: r for r in s.collect()}
    assert summ["6_month"].organic_traffic_pct == 18.0
    assert summ["6_month"].total_spend == 65000.0


def test_benchmark_cpc_and_zero_cpc(spark):
    sc = spark.createDataFrame([(1, "luxury_ecommerce", 1000.0, 50.0, None, None, 2),
                                (2, "luxury_ecommerce", 1000.0, 50.0, 0.0, None, 1)], SCEN)
    bench = spark.createDataFrame([(4.0,)], "avg_cpc double")
    m = {(r.scenario_id, r.month): r for r in G.monthly_projection(sc, G.default_curves(spark), bench).collect()}
    assert m[(1, 1)].effective_cpc == 4.0
    assert m[(1, 1)].effective_cr == 1.5
    # CPC 0 would divide by zero in the source: NULL metrics, no failure
    assert m[(2, 1)].paid_traffic is None


def test_total_equals_paid_plus_organic(spark):
    m, _ = _run(spark, [(i, "luxury_ecommerce", 1000.0 * i, 80.0, 1.0 + i / 10, 2.0, 12) for i in range(1, 6)])
    for r in m.collect():
        assert abs(r.total_traffic - (r.paid_traffic + r.organic_traffic)) <= 1


def _scenarios(spark, *rows):
    return spark.createDataFrame(list(rows), "client_id string, " + SCEN)


def test_unknown_industry_months_and_keyed_benchmark(spark):
    sc = _scenarios(spark, ("a", 1, "luxury_ecommerce", 1000.0, 100.0, None, 1.5, 2), ("b", 2, "other", 1000.0, 100.0, None, 1.5, 2),
                    ("c", 3, "other", 1000.0, 100.0, None, 1.5, 0), ("c", 4, "other", 1000.0, 100.0, None, 1.5, None))
    bench = spark.createDataFrame([("a", 4.0), ("a", 4.0), ("z", 9.0)], "client_id string, avg_cpc double")
    got = {(r.scenario_id, r.month): r for r in G.monthly_projection(sc, G.default_curves(spark), bench).collect()}
    assert sorted(got) == [(1, 1), (1, 2), (2, 1), (2, 2)] + [(4, m) for m in range(1, 7)]
    assert got[1, 1].effective_cpc == pytest.approx(4.0 * G.CPC_MULT[0], abs=0.01)
    assert got[2, 1].effective_cpc == pytest.approx(G.DEFAULT_CPC * G.CPC_MULT[0], abs=0.01)
    assert got[2, 1].organic_pct == G.ORGANIC_PCT[0]


def test_unkeyed_benchmark_never_drops_or_doubles(spark):
    sc = _scenarios(spark, ("a", 1, "luxury_ecommerce", 1000.0, 100.0, None, 1.5, 3))
    for rows in ([], [(2.0,), (2.0,)]):
        bench = spark.createDataFrame(rows, "avg_cpc double")
        assert G.monthly_projection(sc, G.default_curves(spark), bench).count() == 3
