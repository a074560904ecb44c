"""Growth projections (G-01 ... G-03, J-01, J-02, A-08, S-05, X-21).

A scenario row (scenario_id, industry, monthly_ad_spend, aov, cpc,
conversion_rate, months) becomes ``months`` monthly rows by a narrow
``explode(sequence)``; the benchmark curves are a size-bounded dimension
(12 rows per industry) joined by broadcast; every formula is a column
expression; the summary is one grouped aggregation over *rounded* months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import dround

# Default benchmark of the source tool (industry
# 'luxury_ecommerce'): organic share of traffic (percent) and CPC
# optimisation multiplier by month 1..12; fallbacks past month 12.
DEFAULT_INDUSTRY = "luxury_ecommerce"
ORGANIC_PCT = [5, 7, 10, 12, 15, 18, 22, 25, 28, 30, 32, 35]
CPC_MULT = [1.0, 0.95, 0.90, 0.85, 0.82, 0.80, 0.78, 0.76, 0.75, 0.74, 0.73, 0.72]
ORGANIC_PCT_FALLBACK = 35
CPC_MULT_FALLBACK = 0.75
DEFAULT_CPC = 2.50
DEFAULT_CONVERSION_RATE = 1.5
DEFAULT_MONTHS = 6
# Conversion-rate steps: x1 up to month 3, x1.5 up to month 6, x2 after;
# organic traffic converts 1.3x the paid rate.
CR_STEPS = ((3, 1.0), (6, 1.5))
CR_LATE = 2.0
ORGANIC_CR_LIFT = 1.3

MONTHLY_COLUMNS = ["month", "ad_spend", "effective_cpc", "effective_cr", "paid_traffic", "paid_orders",
                   "paid_revenue", "organic_pct", "organic_traffic", "organic_orders", "organic_revenue",
                   "total_traffic", "total_orders", "total_revenue", "roas", "cac"]


def default_curves(spark: SparkSession) -> DataFrame:
    """S-05 default benchmark curves as a 12-row dimension."""
    rows = [(DEFAULT_INDUSTRY, m + 1, ORGANIC_PCT[m], CPC_MULT[m]) for m in range(12)]
    return spark.createDataFrame(rows, "industry string, month int, organic_pct int, cpc_mult double")


def resolve_inputs(scenarios: DataFrame, benchmark: DataFrame | None = None) -> DataFrame:
    """G-02: CPC <- given, else benchmark ``avg_cpc``, else 2.50;
    conversion rate <- given, else 1.5; months <- given, else 6.  A
    ``benchmark`` with a client_id meets the scenarios of that client (the
    lowest CPC if a client has several rows); one without is a single number
    for all, aggregated to one row, so it can neither drop nor double rows."""
    s = scenarios.withColumn("months", F.coalesce(F.col("months"), F.lit(DEFAULT_MONTHS)))
    if benchmark is not None:
        cpc_of = F.min("avg_cpc").alias("__bench_cpc")
        if "client_id" in benchmark.columns and "client_id" in s.columns:
            s = s.join(benchmark.groupBy("client_id").agg(cpc_of), "client_id", "left")
        else:
            s = s.crossJoin(benchmark.agg(cpc_of))  # one row, whatever the input
        cpc = F.coalesce(F.col("cpc"), F.col("__bench_cpc"), F.lit(DEFAULT_CPC))
    else:
        cpc = F.coalesce(F.col("cpc"), F.lit(DEFAULT_CPC))
    out = s.withColumns({"base_cpc": cpc,
                         "base_cr": F.coalesce(F.col("conversion_rate"), F.lit(DEFAULT_CONVERSION_RATE))})
    return out.drop("__bench_cpc") if benchmark is not None else out


def monthly_projection(scenarios: DataFrame, curves: DataFrame, benchmark: DataFrame | None = None) -> DataFrame:
    """G-01 / J-01 / J-02 / G-03: one row per (scenario, month), with its
    client_id if scenarios have one, and 16 metric columns rounded like the source (decimal-then-round, HALF_UP).

    ``paid_clicks = spend / effective_cpc`` is unguarded in the source and
    raises on CPC 0; we emit NULL metrics there instead of failing the job.
    An industry without curves uses the default ones; no month is projected
    for ``months`` below 1.
    """
    s = resolve_inputs(scenarios, benchmark)
    known = curves.select("industry").distinct().withColumn("__known", F.lit(True))
    s = s.join(known, "industry", "left").withColumn(
        "industry", F.when(F.col("__known"), F.col("industry")).otherwise(F.lit(DEFAULT_INDUSTRY))).drop("__known")
    grid = s.select("*", F.explode(F.when(F.col("months") >= 1, F.sequence(F.lit(1), F.col("months")))).alias("month"))
    g = grid.join(curves, ["industry", "month"], "left")
    spend, aov, m = F.col("monthly_ad_spend"), F.col("aov"), F.col("month")
    cpc_mult = F.coalesce(F.col("cpc_mult"), F.lit(CPC_MULT_FALLBACK))
    eff_cpc = F.col("base_cpc") * cpc_mult
    step = F.lit(CR_LATE)
    for upto, mult in reversed(CR_STEPS):
        step = F.when(m <= upto, F.lit(mult)).otherwise(step)
    eff_cr = F.when(m <= CR_STEPS[0][0], F.col("base_cr")).otherwise(F.col("base_cr") * step)
    g = g.withColumns({"_cpc": eff_cpc, "_cr": eff_cr})
    g = g.withColumn("_clicks", F.when(F.col("_cpc") != 0, spend / F.when(F.col("_cpc") != 0, F.col("_cpc"))))
    g = g.withColumns({
        "_porders": F.col("_clicks") * (F.col("_cr") / 100),
        "_opct": F.coalesce(F.col("organic_pct"), F.lit(ORGANIC_PCT_FALLBACK)).cast("double") / 100,
    })
    g = g.withColumns({
        "_prev": F.col("_porders") * aov,
        "_ttraffic": F.when(F.col("_opct") < 1, F.col("_clicks") / (F.lit(1.0) - F.col("_opct")))
                      .otherwise(F.col("_clicks")),
    })
    g = g.withColumn("_otraffic", F.col("_ttraffic") * F.col("_opct"))
    g = g.withColumn("_oorders", F.col("_otraffic") * ((F.col("_cr") * ORGANIC_CR_LIFT) / 100))
    g = g.withColumn("_orev", F.col("_oorders") * aov)
    g = g.withColumns({"_torders": F.col("_porders") + F.col("_oorders"),
                       "_trev": F.col("_prev") + F.col("_orev")})
    roas = F.when(spend > 0, F.col("_trev") / F.when(spend > 0, spend)).otherwise(F.lit(0.0))
    cac = F.when(F.col("_torders") > 0, spend / F.when(F.col("_torders") > 0, F.col("_torders"))).otherwise(F.lit(0.0))
    client = [c for c in ("client_id",) if c in scenarios.columns]
    return g.select(
        *client, "scenario_id", "month",
        dround(spend, 2).alias("ad_spend"),
        dround(F.col("_cpc"), 2).alias("effective_cpc"),
        dround(F.col("_cr"), 2).alias("effective_cr"),
        dround(F.col("_clicks"), 0).cast("long").alias("paid_traffic"),
        dround(F.col("_porders"), 1).alias("paid_orders"),
        dround(F.col("_prev"), 2).alias("paid_revenue"),
        dround(F.col("_opct") * 100, 1).alias("organic_pct"),
        dround(F.col("_otraffic"), 0).cast("long").alias("organic_traffic"),
        dround(F.col("_oorders"), 1).alias("organic_orders"),
        dround(F.col("_orev"), 2).alias("organic_revenue"),
        dround(F.col("_ttraffic"), 0).cast("long").alias("total_traffic"),
        dround(F.col("_torders"), 1).alias("total_orders"),
        dround(F.col("_trev"), 2).alias("total_revenue"),
        dround(roas, 2).alias("roas"),
        dround(cac, 2).alias("cac"),
    )


def projection_summary(monthly: DataFrame) -> DataFrame:
    """A-08: per scenario (of a client, if there are clients), a '3_month' row (first three months) and a
    '6_month' row (*all* projected months, as in the source), summing the
    already rounded monthly values exactly (decimal sums).  Organic share:
    month 3 (0 when fewer), month 6 (else the last month).  avg_cac over
    the whole horizon, on both rows.  One grouped aggregation."""
    dec = lambda c: F.col(c).cast("decimal(38,2)")
    first3 = F.col("month") <= 3
    key = [c for c in ("client_id", "scenario_id") if c in monthly.columns]
    agg = monthly.groupBy(*key).agg(
        F.sum(F.when(first3, dec("ad_spend"))).alias("s3"),
        F.sum(F.when(first3, dec("total_revenue"))).alias("r3"),
        F.sum(F.when(first3, dec("total_orders"))).alias("o3"),
        F.sum(dec("ad_spend")).alias("s6"),
        F.sum(dec("total_revenue")).alias("r6"),
        F.sum(dec("total_orders")).alias("o6"),
        F.max(F.when(F.col("month") == 3, F.col("organic_pct"))).alias("p3"),
        F.max(F.when(F.col("month") == 6, F.col("organic_pct"))).alias("p6"),
        F.max_by("organic_pct", "month").alias("plast"))
    d = lambda c: F.col(c).cast("double")

    def horizon(name, s, r, o, pct):
        roas = F.when(d(s) > 0, d(r) / F.when(d(s) > 0, d(s))).otherwise(F.lit(0.0))
        return F.struct(F.lit(name).alias("horizon"),
                        dround(d(s), 2).alias("total_spend"), dround(d(r), 2).alias("total_revenue"),
                        dround(d(o), 1).alias("total_orders"), dround(roas, 2).alias("roas"),
                        pct.alias("organic_traffic_pct"),
                        dround(F.lit(100.0) - pct, 1).alias("paid_traffic_pct"))

    avg_cac = F.when(d("o6") > 0, d("s6") / F.when(d("o6") > 0, d("o6"))).otherwise(F.lit(0.0))
    rows = F.array(horizon("3_month", "s3", "r3", "o3", F.coalesce(F.col("p3"), F.lit(0.0))),
                   horizon("6_month", "s6", "r6", "o6", F.coalesce(F.col("p6"), F.col("plast"))))
    return agg.select(*key, F.explode(rows).alias("h"), dround(avg_cac, 2).alias("avg_cac")).select(
        *key, "h.*", "avg_cac")
