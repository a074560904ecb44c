"""Dashboard queries and the review search grid."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import dashboard as D
from ..operators import keywords as K
from ..operators import links as L
from ..operators import reviews as R
from ..sources.fixtures import clients_df, keyword_obs_df, links_df, paid_kw_df, views_then, with_views
from ..sources.tables import Tables
from .q_keywords import _TYPED, KEYWORD_GAP_SQL, _roles
from .q_links import _FACTS, _REG, backlink_roles
from .registry import register


DASHBOARD_KEYWORDS_SQL = views_then(f"""
{_TYPED.replace('SRC', 'keyword_obs_v')}
select client_id, lower(keyword) as keyword,
       arg_max(coalesce(volume, 0.0), seq) as volume, arg_max(coalesce(kd, 0.0), seq) as kd,
       arg_max(coalesce(cpc, 0.0), seq) as cpc, arg_max(coalesce(intent, 'Unknown'), seq) as intent
from typed where keyword is not null and keyword <> '' group by client_id, lower(keyword)""", "keyword_obs_v")


@register("dashboard_keywords", "D-01,X-06,X-20", DASHBOARD_KEYWORDS_SQL)
def dashboard_keywords(spark, sf_dir):
    return D.keyword_map(K.parse_metrics(keyword_obs_df(Tables(spark, sf_dir))), by=("client_id",))


DASHBOARD_KEYWORD_GAP_SQL = KEYWORD_GAP_SQL.replace(
    "\nselect client_id, keyword,", ",\ngap as (select client_id, keyword,", 1) + """)
select *, cast(row_number() over (partition by client_id order by best_position, keyword) as integer) as rank
from gap where status = 'missing'
qualify row_number() over (partition by client_id order by best_position, keyword) <= 50"""


@register("dashboard_keyword_gap", "K-12", DASHBOARD_KEYWORD_GAP_SQL)
def dashboard_keyword_gap(spark, sf_dir):
    t = Tables(spark, sf_dir)
    roles = _roles(t)
    return D.gap_slice(K.domain_keyword_gap(paid_kw_df(t, domains=roles), roles, max_competitors=4))


_ROLES = """roles as (select 'links' || (n // 5) as client_id, n % 5 as seq, target_host as domain
          from (select target_host, row_number() over (order by target_host) - 1 as n
                from (select distinct target_host from facts)))"""

DASHBOARD_BACKLINKS_SQL = views_then(_FACTS + ",\n" + _ROLES + f""",
ov as (select target_host, count(*) as total_backlinks, count(distinct {_REG.format('src_host')}) as referring_domains,
              count_if(not nofollow) as follow_links, count_if(nofollow) as nofollow_links
       from facts where src_host <> target_host group by 1),
j as (select r.client_id, r.seq, r.domain, r.seq = 0 as is_target,
             cast(coalesce(ov.referring_domains, 0) as double) as authority_score,
             coalesce(ov.total_backlinks, 0) as total_backlinks, coalesce(ov.referring_domains, 0) as referring_domains,
             coalesce(ov.follow_links, 0) as follow_links, coalesce(ov.nofollow_links, 0) as nofollow_links
      from roles r left join ov on r.domain = ov.target_host)
select client_id, domain, is_target, authority_score, total_backlinks, referring_domains, follow_links,
       nofollow_links, cast(row_number() over (partition by client_id order by authority_score desc, seq) as integer) as rank
from j""", "links_v")


@register("dashboard_backlinks", "D-02,K-06,X-20", DASHBOARD_BACKLINKS_SQL)
def dashboard_backlinks(spark, sf_dir):
    facts = L.normalise_link_facts(links_df(Tables(spark, sf_dir)))
    ov = L.backlink_overview(facts)
    # no vendor authority score in the tables: referring domains stand in
    ov = ov.withColumn("authority_score", F.col("referring_domains"))
    return D.backlink_comparison(ov, backlink_roles(facts))


DASHBOARD_TARGET_SQL = views_then(_FACTS + ",\n" + _ROLES + f""",
x as (select * from facts where src_host <> target_host),
pg as (select target_host, 'top_pages' as section, target_path as item,
              count(distinct {_REG.format('src_host')}) as referring_domains, count(*) as backlinks from x group by 1, 3),
an as (select target_host, 'top_anchors' as section, anchor as item,
              count(distinct {_REG.format('src_host')}) as referring_domains, count(*) as backlinks from x group by 1, 3),
rd as (select target_host, 'referring_domains' as section, {_REG.format('src_host')} as item,
              cast(null as bigint) as referring_domains, count(*) as backlinks from x group by 1, 3),
ranked as (
  select *, row_number() over (partition by target_host order by backlinks desc, referring_domains desc, item) as rank from pg
  union all
  select *, row_number() over (partition by target_host order by referring_domains desc, backlinks desc, item) from an
  union all
  select *, row_number() over (partition by target_host order by backlinks desc, item) from rd)
select r.client_id, k.target_host as domain, k.section, cast(k.rank as integer) as rank, k.item,
       k.referring_domains, k.backlinks
from ranked k join roles r on r.domain = k.target_host and r.seq = 0
where (k.section = 'top_pages' and k.rank <= 20) or (k.section = 'top_anchors' and k.rank <= 20)
   or (k.section = 'referring_domains' and k.rank <= 30)""", "links_v")


@register("dashboard_target", "D-02,K-07,J-07", DASHBOARD_TARGET_SQL)
def dashboard_target(spark, sf_dir):
    facts = L.normalise_link_facts(links_df(Tables(spark, sf_dir)))
    return D.target_slices(backlink_roles(facts), L.top_pages(facts, 30), L.anchors(facts, 30),
                           L.referring_domains(facts, 50))


# ---- review search grid (J-03, X-19) ---------------------------------------
# Default store types of the review search settings.
STORE_TYPES = ["store", "outlet", "boutique"]


def _grid_inputs(t):
    c = clients_df(t)
    comps = c.filter(F.col("seq") > 0).select("client_id", "seq", "name", "domain")
    n = t.nation.select("n_name", "n_regionkey")
    # locations of a client: the nations of its region, in key order
    locs = (n.alias("a").join(n.alias("b"), F.col("a.n_regionkey") == F.col("b.n_regionkey"))
            .select(F.col("a.n_name").alias("client_id"), F.col("b.n_name").alias("location")))
    locs = locs.withColumn("seq", F.row_number().over(W.partitionBy("client_id").orderBy("location")))
    types = c.select("client_id").distinct().select(
        "client_id", F.posexplode(F.array(*[F.lit(s) for s in STORE_TYPES])).alias("seq", "store_type"))
    return comps, locs, types


REVIEW_QUERY_GRID_SQL = with_views("select 1", "clients_v").replace("\nselect 1", "") + f""",
comps as (select client_id, seq, coalesce(name, split_part(domain, '.', 1)) as brand from clients_v where seq > 0),
locs as (select a.n_name as client_id, b.n_name as location,
                row_number() over (partition by a.n_name order by b.n_name) as item_seq
         from nation a join nation b on a.n_regionkey = b.n_regionkey),
types as (select distinct c.client_id, t.store_type, t.item_seq from clients_v c,
          (select unnest({STORE_TYPES!r}) as store_type, generate_subscripts({STORE_TYPES!r}, 1) - 1 as item_seq) t)
select c.client_id, c.seq, c.brand, 0 as kind_order, cast(l.item_seq as integer) as item_seq,
       c.brand || ' store ' || l.location as query
from comps c join locs l on c.client_id = l.client_id
union all
select c.client_id, c.seq, c.brand, 1, cast(t.item_seq as integer), c.brand || ' ' || t.store_type
from comps c join types t on c.client_id = t.client_id where t.store_type <> 'store'"""


@register("review_query_grid", "J-03,X-19", REVIEW_QUERY_GRID_SQL)
def review_query_grid(spark, sf_dir):
    return R.review_query_grid(*_grid_inputs(Tables(spark, sf_dir)))
