"""Projection queries: monthly grid and horizon summary per scenario."""

from __future__ import annotations

from ..operators import projections as G
from ..sources.fixtures import SCENARIO_SQL, scenario_df
from ..sources.tables import Tables
from .oracle_sql import dround_sql
from .q_paid import INDUSTRY_AVERAGES_SQL, average_cpc_df
from .registry import register


def _curves_sql() -> str:
    rows = " union all ".join(
        f"select '{G.DEFAULT_INDUSTRY}' as industry, {m + 1} as month, {G.ORGANIC_PCT[m]} as organic_pct, "
        f"cast({G.CPC_MULT[m]!r} as double) as cpc_mult" for m in range(12))
    return f"curves as ({rows})"


def _monthly_sql() -> str:
    # the benchmark avg CPC comes from the industry-averages query
    bench = INDUSTRY_AVERAGES_SQL
    bench_ctes, bench_select = bench.rsplit("\nselect ", 1)
    return bench_ctes + ",\n" + f"""bench as (select {bench_select}),
{_curves_sql()},
sv as ({SCENARIO_SQL}),
s as (select sv.*, coalesce(sv.cpc, bench.avg_cpc, {G.DEFAULT_CPC}) as base_cpc,
             coalesce(sv.conversion_rate, {G.DEFAULT_CONVERSION_RATE}) as base_cr from sv left join bench on sv.client_id = bench.client_id),
g as (select s.*, unnest(range(1, coalesce(months, 6) + 1)) as month from s),
c as (select g.*, coalesce(cv.cpc_mult, {G.CPC_MULT_FALLBACK}) as mult,
             cast(coalesce(cv.organic_pct, {G.ORGANIC_PCT_FALLBACK}) as double) / 100 as opct
      from g left join curves cv on cv.industry = 'luxury_ecommerce' and g.month = cv.month),
e as (select *, base_cpc * mult as ecpc,
             case when month <= 3 then base_cr else base_cr * (case when month <= 6 then 1.5 else 2.0 end) end as ecr
      from c),
p as (select *, case when ecpc <> 0 then monthly_ad_spend / ecpc end as clicks from e),
p2 as (select *, clicks * (ecr / 100) as porders,
              case when opct < 1 then clicks / (1.0 - opct) else clicks end as ttraffic from p),
p3 as (select *, porders * aov as prev, ttraffic * opct as otraffic from p2),
p4 as (select *, otraffic * ((ecr * {G.ORGANIC_CR_LIFT}) / 100) as oorders from p3),
p5 as (select *, oorders * aov as orev, porders + oorders as torders from p4),
p6 as (select *, prev + orev as trev from p5),
monthly as (select client_id, scenario_id, cast(month as integer) as month,
       {dround_sql('monthly_ad_spend', 2)} as ad_spend, {dround_sql('ecpc', 2)} as effective_cpc,
       {dround_sql('ecr', 2)} as effective_cr, cast({dround_sql('clicks', 0)} as bigint) as paid_traffic,
       {dround_sql('porders', 1)} as paid_orders, {dround_sql('prev', 2)} as paid_revenue,
       {dround_sql('opct * 100', 1)} as organic_pct, cast({dround_sql('otraffic', 0)} as bigint) as organic_traffic,
       {dround_sql('oorders', 1)} as organic_orders, {dround_sql('orev', 2)} as organic_revenue,
       cast({dround_sql('ttraffic', 0)} as bigint) as total_traffic, {dround_sql('torders', 1)} as total_orders,
       {dround_sql('trev', 2)} as total_revenue,
       {dround_sql('case when monthly_ad_spend > 0 then trev / monthly_ad_spend else 0.0 end', 2)} as roas,
       {dround_sql('case when torders > 0 then monthly_ad_spend / torders else 0.0 end', 2)} as cac
from p6)"""


PROJECTION_MONTHLY_SQL = _monthly_sql() + "\nselect * from monthly"


def _monthly_df(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return G.monthly_projection(scenario_df(t), G.default_curves(spark), average_cpc_df(t))


@register("projection_monthly", "G-01,G-02,G-03,J-01,J-02,X-21,S-05", PROJECTION_MONTHLY_SQL)
def projection_monthly(spark, sf_dir):
    return _monthly_df(spark, sf_dir)


def _summary_sql() -> str:
    d = "cast({} as decimal(38,2))"
    return _monthly_sql() + f""",
agg as (select client_id, scenario_id,
   sum(case when month <= 3 then {d.format('ad_spend')} end) as s3,
   sum(case when month <= 3 then {d.format('total_revenue')} end) as r3,
   sum(case when month <= 3 then {d.format('total_orders')} end) as o3,
   sum({d.format('ad_spend')}) as s6, sum({d.format('total_revenue')}) as r6, sum({d.format('total_orders')}) as o6,
   max(case when month = 3 then organic_pct end) as p3, max(case when month = 6 then organic_pct end) as p6,
   arg_max(organic_pct, month) as plast
 from monthly group by client_id, scenario_id),
h as (select client_id, scenario_id, '3_month' as horizon, cast(s3 as double) as s, cast(r3 as double) as r,
             cast(o3 as double) as o, coalesce(p3, 0.0) as pct, cast(s6 as double) as ts, cast(o6 as double) as tot
      from agg
      union all
      select client_id, scenario_id, '6_month', cast(s6 as double), cast(r6 as double), cast(o6 as double),
             coalesce(p6, plast), cast(s6 as double), cast(o6 as double) from agg)
select client_id, scenario_id, horizon, {dround_sql('s', 2)} as total_spend, {dround_sql('r', 2)} as total_revenue,
       {dround_sql('o', 1)} as total_orders, {dround_sql('case when s > 0 then r / s else 0.0 end', 2)} as roas,
       pct as organic_traffic_pct, {dround_sql('100.0 - pct', 1)} as paid_traffic_pct,
       {dround_sql('case when tot > 0 then ts / tot else 0.0 end', 2)} as avg_cac
from h"""


PROJECTION_SUMMARY_SQL = _summary_sql()


@register("projection_summary", "A-08,X-21", PROJECTION_SUMMARY_SQL)
def projection_summary(spark, sf_dir):
    return G.projection_summary(_monthly_df(spark, sf_dir))
