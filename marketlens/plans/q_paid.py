"""Paid-media queries: top paid keywords, industry averages, summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import paid as P
from ..sources.fixtures import PAID_ORDER, clients_df, keyword_obs_df, paid_kw_df, raw_cards_df, views_then, with_views
from ..sources.tables import Tables
from .oracle_sql import dround_sql
from .registry import register


def market_lookups_df(t: Tables):
    """Keyword-overview lookups of the market keywords (source 1), with the
    missing / empty / unparseable CPC strings a scrape produces."""
    obs = keyword_obs_df(t).filter(F.col("source_rank") == 1)
    cpc = (F.when(F.col("seq") % 7 == 3, F.lit(None).cast("string"))
           .when(F.col("seq") % 11 == 4, F.lit(""))
           .when(F.col("seq") % 13 == 5, F.lit("n/a")).otherwise(F.col("cpc_raw")))
    return obs.select("client_id", "seq", "keyword", "volume_raw", cpc.alias("cpc_raw"),
                      F.col("kd_raw").alias("competition_raw"))


MARKET_SQL = """market as (
  select client_id, seq, keyword, volume_raw,
         case when seq % 7 = 3 then null when seq % 11 = 4 then '' when seq % 13 = 5 then 'n/a' else cpc_raw end as cpc_raw,
         kd_raw as competition_raw
  from keyword_obs_v where source_rank = 1)"""


def _cpc_sql(col: str) -> str:
    s = f"replace(replace({col}, '$', ''), ',', '')"
    t = f"regexp_replace({s}, '^\\s+|\\s+$', '', 'g')"
    return (f"(case when {s} <> '' and regexp_full_match({t}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') "
            f"then try_cast({t} as double) end)")


def _legacy_volume_sql(col: str) -> str:
    s = f"replace(replace(replace({col}, ',', ''), 'K', '000'), 'M', '000000')"
    return f"(case when regexp_full_match({s}, '([0-9]+\\.?[0-9]*|\\.[0-9]+)') then try_cast({s} as double) end)"


PAID_TOP10_SQL = with_views("""
select * from (select *, cast(row_number() over (partition by domain order by position) as integer) as kw_rank
               from paid_kw_v) where kw_rank <= 10""", "paid_kw_v")


@register("paid_top10", "K-08", PAID_TOP10_SQL)
def paid_top10(spark, sf_dir):
    return P.top_paid_keywords(paid_kw_df(Tables(spark, sf_dir), max_position=10), n=10)


CLIENT = ("client_id",)
# Fixed value: market keywords of a client that the tool looks up.
TOOL_LOOKUPS = 20


def _industry_averages_sql(max_keywords: int | None) -> str:
    first = f"where n <= {max_keywords}" if max_keywords is not None else ""
    return views_then(MARKET_SQL + f""",
comps as (select distinct client_id, domain from clients_v where seq > 0 and domain is not null and domain <> ''),
top as (select * from (select p.*, c.client_id,
                              row_number() over (partition by c.client_id, p.domain order by p.position) as rk
                       from paid_kw_v p join comps c on p.domain = c.domain) where rk <= 10),
numbered as (select *, row_number() over (partition by client_id order by seq) as n from market),
lookups as (select client_id, keyword, arg_max(volume_raw, seq) as volume_raw, arg_max(cpc_raw, seq) as cpc_raw
            from (select client_id, keyword, seq, coalesce(volume_raw, '<none>') as volume_raw, coalesce(cpc_raw, '<none>') as cpc_raw
                  from numbered {first}) group by client_id, keyword),
lk0 as (select client_id, keyword, nullif(volume_raw, '<none>') as volume_raw, nullif(cpc_raw, '<none>') as cpc_raw from lookups),
lk as (select client_id, keyword, volume_raw, cpc_raw, replace(replace(coalesce(cpc_raw, 'None'), '$', ''), ',', '') as cs,
              {_cpc_sql("coalesce(cpc_raw, 'None')")} as cv from lk0),
pool as (select client_id, {_cpc_sql('cpc_raw')} as cpc, cast(null as double) as volume from top
         union all
         select client_id, cv, case when not (cs <> '' and cv is null) then {_legacy_volume_sql("coalesce(volume_raw, '')")} end
         from lk),
st as (select client_id, {dround_sql('avg(cpc)', 6)} as avg_cpc, min(cpc) as min_cpc, max(cpc) as max_cpc,
              percentile_disc(0.5) within group (order by cpc desc) as median_cpc,
              {dround_sql('avg(volume)', 6)} as avg_volume from pool group by client_id),
nk as (select client_id, count(*) as n from lookups group by client_id),
nc as (select client_id, count(*) as n from comps group by client_id),
averages as (select client_id, st.avg_cpc, st.min_cpc, st.max_cpc, st.median_cpc, st.avg_volume,
                    coalesce(nk.n, 0) as total_keywords_analyzed, coalesce(nc.n, 0) as total_competitors_analyzed
             from st full join nk using (client_id) full join nc using (client_id))
select * from averages""", "keyword_obs_v", "paid_kw_v", "clients_v")


INDUSTRY_AVERAGES_SQL = _industry_averages_sql(None)


def _pooled(t: Tables, max_keywords=None):
    """The CPC pool, the lookups and the competitors of every client."""
    comps = (clients_df(t).filter((F.col("seq") > 0) & F.col("domain").isNotNull() & (F.col("domain") != ""))
             .select(*CLIENT, "domain").distinct())
    # only the first ten positions of each competitor are pooled (K-08)
    top = P.top_paid_keywords(paid_kw_df(t, max_position=10, domains=comps).join(comps, "domain"), n=10, by=(*CLIENT, "domain"))
    lookups = P.keyword_lookups(market_lookups_df(t), max_keywords, CLIENT)
    return P.cpc_pool(top, lookups, CLIENT), lookups, comps


def industry_averages_df(spark, sf_dir, max_keywords=None):
    pool, lookups, comps = _pooled(Tables(spark, sf_dir), max_keywords)
    return P.industry_averages(pool, lookups.groupBy(*CLIENT).agg(F.count(F.lit(1)).alias("total_keywords_analyzed")),
                               comps.groupBy(*CLIENT).agg(F.count(F.lit(1)).alias("total_competitors_analyzed")), CLIENT)


def average_cpc_df(t: Tables):
    """The one number of the industry averages that projections read."""
    return P.average_cpc(_pooled(t)[0], CLIENT)


@register("industry_averages", "A-06,U-02,X-02,X-03,K-10,C-05", INDUSTRY_AVERAGES_SQL)
def industry_averages(spark, sf_dir):
    return industry_averages_df(spark, sf_dir)


@register("first_lookups_industry_averages", "K-10,A-06", _industry_averages_sql(TOOL_LOOKUPS))
def first_lookups_industry_averages(spark, sf_dir):
    return industry_averages_df(spark, sf_dir, TOOL_LOOKUPS)


PAID_SUMMARY_SQL = views_then(f"""
cards as (select domain,
                 case when len("values") >= 3 then "values"[1] end as paid_keywords_raw,
                 case when len("values") >= 3 then "values"[2] end as paid_traffic_raw,
                 case when len("values") >= 3 then "values"[3] end as paid_cost_raw,
                 "values"[1] as pla_keywords_raw from raw_cards_v),
ov as (select domain, count(distinct keyword) as n_keywords, sum(clicks) as traffic,
              {dround_sql(f"sum(clicks * coalesce({_cpc_sql('cpc_raw')}, 0.0))", 2)} as traffic_cost,
              arg_min(keyword, position) as top_keyword, arg_min(cpc_raw, position) as top_cpc
       from paid_kw_v group by domain)
select c.domain, c.paid_keywords_raw, c.paid_traffic_raw, c.paid_cost_raw, c.pla_keywords_raw,
       coalesce(o.n_keywords, 0) as n_keywords, coalesce(o.traffic, 0.0) as traffic,
       coalesce(o.traffic_cost, 0.0) as traffic_cost, coalesce(o.top_keyword, '') as top_keyword,
       coalesce(o.top_cpc, '') as top_cpc
from cards c left join ov o on c.domain = o.domain""", "raw_cards_v", "paid_kw_v")


@register("paid_summary", "D-03,J-05,A-15,K-09,C-03,C-06", PAID_SUMMARY_SQL)
def paid_summary(spark, sf_dir):
    t = Tables(spark, sf_dir)
    # the first by position, without numbering any line
    return P.paid_summary(raw_cards_df(t), paid_kw_df(t, positions=False, order_columns=True), PAID_ORDER)
