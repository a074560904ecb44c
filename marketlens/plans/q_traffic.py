"""Traffic queries over events, orders/customers/nations and lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import traffic as T
from ..sources.tables import Tables
from .oracle_sql import dround_sql
from .registry import register

_SESS = """s as (select *, lag(ts) over w as pts, lead(ts) over w as nts, lead(event_type) over w as nkind
      from events window w as (partition by user_id order by ts, event_id)),
f as (select *, (pts is null or epoch_us(ts) - epoch_us(pts) > 1800000000) as is_start,
             (nts is null or epoch_us(nts) - epoch_us(ts) > 1800000000) as is_end from s)"""


TRAFFIC_OVERVIEW_SQL = f"""with {_SESS},
a as (select count_if(is_start) as visits, count(distinct user_id) as unique_users, count(*) as events,
             count_if(is_start and is_end) as bounces from f)
select visits, unique_users, events,
       {dround_sql('case when visits > 0 then events / cast(visits as double) else 0.0 end', 6)} as events_per_visit,
       {dround_sql('case when visits > 0 then bounces / cast(visits as double) else 0.0 end', 6)} as bounce_rate
from a"""


@register("traffic_overview", "T-01", TRAFFIC_OVERVIEW_SQL)
def traffic_overview(spark, sf_dir):
    return T.traffic_overview(Tables(spark, sf_dir).events)


CHANNELS_SQL = f"""with a as (select event_type, count(*) as n_events, sum(value) as value from events group by 1)
select event_type, n_events, {dround_sql('value', 4)} as value,
       {dround_sql('n_events / sum(n_events) over ()', 6)} as share_events,
       {dround_sql('value / sum(value) over ()', 6)} as share_value from a"""


@register("channels", "T-02", CHANNELS_SQL)
def channels(spark, sf_dir):
    return T.channel_share(Tables(spark, sf_dir).events)


JOURNEY_SQL = f"""with {_SESS},
a as (select event_type as from_type, nkind as to_type, count(*) as n from f where not is_end group by 1, 2)
select from_type, to_type, n, {dround_sql('n / sum(n) over (partition by from_type)', 6)} as probability from a"""


@register("journey", "T-03", JOURNEY_SQL)
def journey(spark, sf_dir):
    return T.journeys(Tables(spark, sf_dir).events)


TREND_SQL = f"""with d as (select cast(ts as date) as day, count(*) as events, count(distinct user_id) as users
           from events group by 1)
select day, events, users,
       {dround_sql('case when lag(events) over (order by day) > 0 then events / lag(events) over (order by day) - 1 end', 6)} as change,
       {dround_sql('avg(events) over (order by day rows between 6 preceding and current row)', 6)} as moving_avg_7
from d"""


@register("trend", "T-04", TREND_SQL)
def trend(spark, sf_dir):
    return T.daily_trend(Tables(spark, sf_dir).events)


GEO_SQL = f"""with j as (select r.r_name, n.n_name, o.o_totalprice, o.o_custkey
           from orders o join customer c on o.o_custkey = c.c_custkey
           join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey),
a as (select r_name, n_name, sum(o_totalprice) as value, count(distinct o_custkey) as customers
      from j group by rollup (r_name, n_name))
select r_name as region, n_name as nation, {dround_sql('value', 2)} as value, customers,
       {dround_sql('value / max(case when r_name is null and n_name is null then value end) over ()', 6)} as share
from a"""


@register("geo", "T-05", GEO_SQL)
def geo(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return T.geo_distribution(t.orders, t.customer, t.nation, t.region)


KEYWORD_TREND_SQL = f"""with m as (select p.p_name as keyword, cast(date_trunc('month', l.l_shipdate) as date) as month,
                  sum(l.l_quantity) as traffic
           from lineitem l join part p on l.l_partkey = p.p_partkey group by 1, 2)
select keyword, month, traffic,
       {dround_sql('case when lag(traffic) over (partition by keyword order by month) > 0 then traffic / lag(traffic) over (partition by keyword order by month) - 1 end', 6)} as growth
from m"""


@register("keyword_trend", "T-06", KEYWORD_TREND_SQL)
def keyword_trend(spark, sf_dir):
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_partkey", "l_quantity", "l_shipdate")
    p = t.part.select("p_partkey", "p_name")
    facts = li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("p_name").alias("keyword"), F.col("l_shipdate").alias("day"), F.col("l_quantity").alias("qty"))
    return T.keyword_trend(facts)
