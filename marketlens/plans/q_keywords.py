"""Keyword queries: parse, merge, caps, coverage, ranking, gap, related,
organic competitors, top organic keywords."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import INTENT_CODES, INTENT_LABELS
from ..operators import keywords as K
from ..operators.ranking import value_row_number
from ..sources.fixtures import clients_df, keyword_obs_df, paid_kw_df, ranked_kw_df, ranked_targets_df, views_then, with_views
from ..sources.tables import Tables
from .oracle_sql import dround_sql, parse_number_sql, q
from .registry import register

CLIENT = ("client_id",)
# Source tool page sizes: (max groups, max rows per group, max rows) per source; the gap is one page.
SOURCE_CAPS = {2: (5, 20, None), 3: (3, 30, None), 4: (3, 20, None), 5: (None, None, 50)}


def _intent_sql(col: str) -> str:
    codes = " ".join(f"when {col} = {q(k)} then {q(v)}" for k, v in INTENT_CODES.items())
    labels = ", ".join(q(x) for x in INTENT_LABELS)
    return f"case when {col} in ({labels}) then {col} {codes} else 'Unknown' end"


_TYPED = f"""typed as (
  select client_id, seq, source_rank, domain, lower(keyword) as keyword,
         case when {parse_number_sql('volume_raw')} > 0 then {parse_number_sql('volume_raw')} else 0.0 end as volume,
         case when {parse_number_sql('kd_raw')} > 0 and {parse_number_sql('kd_raw')} <= 100
              then {parse_number_sql('kd_raw')} else 0.0 end as kd,
         {parse_number_sql('cpc_raw')} as cpc,
         {_intent_sql('intent_raw')} as intent
  from SRC)"""


def _merged_sql(src: str) -> str:
    return _TYPED.replace("SRC", src) + """,
ranked as (select *, row_number() over (partition by client_id, keyword
             order by source_rank, case when source_rank = 1 then -seq else seq end) as rn from typed),
f1 as (select client_id, keyword, min(source_rank) as first_rank from typed group by all),
f2 as (select t.client_id, t.keyword, f1.first_rank, min(t.seq) as first_seq from typed t
       join f1 on t.client_id = f1.client_id and t.keyword = f1.keyword and t.source_rank = f1.first_rank
       group by t.client_id, t.keyword, f1.first_rank),
merged as (select r.client_id, r.keyword, r.volume, r.kd, r.cpc, r.intent, r.source_rank, r.seq, f2.first_rank, f2.first_seq
           from ranked r join f2 on r.client_id = f2.client_id and r.keyword = f2.keyword where r.rn = 1)"""


def _typed(t):
    return K.parse_metrics(keyword_obs_df(t))


def _merged(t):
    return K.merge_keywords(_typed(t), by=CLIENT)


PARSE_METRICS_SQL = views_then(_TYPED.replace("SRC", "keyword_obs_v") + "\nselect * from typed",
                                "keyword_obs_v")


@register("parse_metrics", "X-01,X-04,X-06,X-07", PARSE_METRICS_SQL)
def parse_metrics(spark, sf_dir):
    return _typed(Tables(spark, sf_dir))


KEYWORD_MERGE_SQL = views_then(_merged_sql("keyword_obs_v") + "\nselect * from merged", "keyword_obs_v")


@register("keyword_merge", "K-03,J-06", KEYWORD_MERGE_SQL)
def keyword_merge(spark, sf_dir):
    return _merged(Tables(spark, sf_dir))


def _capped_src_sql() -> str:
    conds = []
    for src, (g, r, total) in SOURCE_CAPS.items():
        c = f"source_rank = {src}"
        if g is not None:
            c += f" and g_rank <= {g}"
        if r is not None:
            c += f" and r_rank <= {r}"
        if total is not None:
            c += f" and t_rank <= {total}"
        conds.append(f"({c})")
    caps = ", ".join(str(s) for s in SOURCE_CAPS)
    return f"""gf as (select client_id, source_rank, domain, min(seq) as g_first from keyword_obs_v group by 1, 2, 3),
gr as (select client_id, source_rank, domain, row_number() over (partition by client_id, source_rank order by g_first, domain) as g_rank from gf),
capped as (select o.* from (select o.*, gr.g_rank,
             row_number() over (partition by o.client_id, o.source_rank, o.domain order by o.seq) as r_rank,
             row_number() over (partition by o.client_id, o.source_rank order by o.seq) as t_rank
           from keyword_obs_v o join gr on o.client_id = gr.client_id and o.source_rank = gr.source_rank and o.domain = gr.domain) o
           where {' or '.join(conds)} or source_rank not in ({caps}))"""


KEYWORD_CAPPED_MERGE_SQL = views_then(
    _capped_src_sql() + ",\n" + _merged_sql("capped") + "\nselect * from merged", "keyword_obs_v")


@register("keyword_capped_merge", "K-04,K-03", KEYWORD_CAPPED_MERGE_SQL)
def keyword_capped_merge(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return K.merge_keywords(K.parse_metrics(K.cap_sources(keyword_obs_df(t), SOURCE_CAPS, CLIENT)), by=CLIENT)


KEYWORD_COVERAGE_SQL = views_then(_merged_sql("keyword_obs_v") + """
select client_id, count(*) as total_keywords, count_if(volume > 0) as with_volume, count_if(kd > 0) as with_kd,
       count_if(cpc > 0) as with_cpc, count_if(intent <> 'Unknown') as with_intent from merged group by client_id""",
                                   "keyword_obs_v")


@register("keyword_coverage", "A-07", KEYWORD_COVERAGE_SQL)
def keyword_coverage(spark, sf_dir):
    return K.keyword_coverage(_merged(Tables(spark, sf_dir)), CLIENT)


KEYWORD_RANKING_SQL = views_then(_merged_sql("keyword_obs_v") + """
select client_id, keyword, volume, kd, cpc, intent,
       cast(row_number() over (partition by client_id order by volume desc, first_rank, first_seq) as integer) as rank from merged""",
                                  "keyword_obs_v")


@register("keyword_ranking", "K-05", KEYWORD_RANKING_SQL)
def keyword_ranking(spark, sf_dir):
    m = _merged(Tables(spark, sf_dir))
    ranked = value_row_number(m, list(CLIENT), "volume", ["first_rank"], "first_seq")
    return ranked.select(*CLIENT, "keyword", "volume", "kd", "cpc", "intent", F.col("rank").cast("int").alias("rank"))


def _roles(t):
    c = clients_df(t)
    # F-01: the target plus its primary competitors, in settings order
    return c.filter((F.col("seq") == 0) | (F.col("priority") == "primary"))


KEYWORD_GAP_SQL = views_then("""roles as (select client_id, seq, domain from clients_v
               where seq = 0 or priority = 'primary'
               qualify row_number() over (partition by client_id order by seq) <= 5),
j as (select r.client_id, r.seq, p.domain, p.keyword, p.position from paid_kw_v p join roles r on p.domain = r.domain),
a as (select client_id, keyword, bool_or(seq = 0) as in_t,
             count(distinct case when seq > 0 then domain end) as n_competitors,
             min(case when seq > 0 then position end) as best_position,
             min(case when seq = 0 then position end) as target_position
      from j group by client_id, keyword)
select client_id, keyword,
       case when in_t and n_competitors > 0 then 'shared' when in_t then 'unique' else 'missing' end as status,
       n_competitors, best_position, target_position from a""", "clients_v", "paid_kw_v")


@register("keyword_gap", "J-08,F-01", KEYWORD_GAP_SQL)
def keyword_gap(spark, sf_dir):
    t = Tables(spark, sf_dir)
    roles = _roles(t)
    return K.domain_keyword_gap(paid_kw_df(t, domains=roles), roles, max_competitors=4)


# Fixed value: market keywords of a client that the tool looks up related ones for.
TOOL_SEEDS = 5


def _related_sql(n_seeds: int | None) -> str:
    first = f"where n <= {n_seeds}" if n_seeds is not None else ""
    return views_then(_merged_sql("keyword_obs_v") + f""",
heads as (select *, row_number() over (partition by client_id order by seq) as n
          from keyword_obs_v where source_rank = 1),
seeds as (select client_id, lower(regexp_replace(keyword, ' [^ ]+$', '')) as seed, min(seq) as seed_seq
          from heads {first} group by 1, 2),
j as (select s.client_id, s.seed_seq, s.seed, m.keyword, m.volume from merged m join seeds s
      on m.client_id = s.client_id and contains(m.keyword, s.seed) and m.keyword <> s.seed)
select client_id, seed_seq, seed, cast(rk as integer) as rank, keyword, volume from
  (select *, row_number() over (partition by client_id, seed_seq order by volume desc, keyword) as rk from j)
where rk <= 20""", "keyword_obs_v")


def _related(spark, sf_dir, n_seeds=None):
    """Seeds are the head phrases of the market keywords of every client (the
    first ``n_seeds`` keywords where given), numbered by their first keyword."""
    obs = keyword_obs_df(Tables(spark, sf_dir))
    market = obs.filter(F.col("source_rank") == 1)
    if n_seeds is not None:
        first = F.row_number().over(W.partitionBy(*CLIENT).orderBy("seq"))
        market = market.withColumn("n", first).filter(F.col("n") <= n_seeds)
    seeds = (market.groupBy(*CLIENT, F.lower(F.regexp_replace("keyword", " [^ ]+$", "")).alias("seed"))
             .agg(F.min("seq").alias("seed_seq")))
    merged = K.merge_keywords(K.parse_metrics(obs), by=CLIENT)
    return K.related_keywords(seeds, merged.select(*CLIENT, "keyword", "volume"), by=CLIENT)


@register("related_keywords", "J-10", _related_sql(None))
def related_keywords(spark, sf_dir):
    return _related(spark, sf_dir)


@register("first_seeds_related_keywords", "J-10", _related_sql(TOOL_SEEDS))
def first_seeds_related_keywords(spark, sf_dir):
    return _related(spark, sf_dir, TOOL_SEEDS)


ORGANIC_COMPETITORS_SQL = views_then(f"""dk as (select distinct domain, keyword from paid_kw_v),
sizes as (select domain, count(*) as n_kw from dk group by domain),
t as (select client_id, domain as target from clients_v where seq = 0),
pairs as (select t.client_id, t.target, d2.domain, count(*) as shared
          from t join dk d1 on d1.domain = t.target join dk d2 on d1.keyword = d2.keyword
          where d2.domain <> t.target group by 1, 2, 3)
select p.client_id, p.target, p.domain, p.shared,
       {dround_sql('cast(p.shared as double) / cast(a.n_kw + b.n_kw - p.shared as double)', 6)} as score,
       cast(row_number() over (partition by p.client_id order by p.shared desc, p.domain) as integer) as rank
from pairs p join sizes a on a.domain = p.target join sizes b on b.domain = p.domain""",
                                      "clients_v", "paid_kw_v")


@register("organic_competitors", "J-11", ORGANIC_COMPETITORS_SQL)
def organic_competitors(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return K.organic_competitors(paid_kw_df(t, positions=False), clients_df(t).filter(F.col("seq") == 0))


TOP_ORGANIC_COMPETITORS_SQL = views_then(f"""dk as (select distinct domain, keyword from ranked_kw_v),
sizes as (select domain, count(*) as n from dk group by domain),
pairs as (select t.target, d2.domain, count(*) as shared
          from (select distinct target from ranked_targets_v) t join dk d1 on d1.domain = t.target join dk d2 on d1.keyword = d2.keyword
          where d2.domain <> t.target group by 1, 2),
scored as (select p.target, p.domain, p.shared, cast(p.shared as double) / cast(a.n + b.n - p.shared as double) as score
           from pairs p join sizes a on a.domain = p.target join sizes b on b.domain = p.domain),
ranked as (select *, cast(row_number() over (partition by target order by score desc, domain) as integer) as rank from scored)
select t.client_id, r.target, r.domain, r.shared, {dround_sql('r.score', 6)} as score, r.rank
from ranked r join ranked_targets_v t on t.target = r.target where r.rank <= 10""", "ranked_kw_v", "ranked_targets_v")


@register("top_organic_competitors", "J-11", TOP_ORGANIC_COMPETITORS_SQL)
def top_organic_competitors(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return K.top_organic_competitors(ranked_kw_df(t), ranked_targets_df(t), k=10)


def organic_facts(t):
    li = t.lineitem.select("l_partkey", "l_suppkey", "l_quantity")
    p = t.part.select("p_partkey", "p_name")
    s = t.supplier.select("s_suppkey", "s_name")
    return (li.join(p, li.l_partkey == p.p_partkey).join(s, li.l_suppkey == s.s_suppkey)
            .select(F.col("s_name").alias("domain"), F.col("p_name").alias("keyword"),
                    F.col("l_quantity").alias("qty")))


TOP_ORGANIC_SQL = """
with a as (select s.s_name as domain, p.p_name as keyword, sum(l.l_quantity) as traffic
           from lineitem l join part p on l.l_partkey = p.p_partkey join supplier s on l.l_suppkey = s.s_suppkey
           group by 1, 2)
select domain, keyword, traffic, cast(rk as integer) as rank from
  (select *, row_number() over (partition by domain order by traffic desc, keyword) as rk from a)
where rk <= 10"""


@register("top_organic", "K-13", TOP_ORGANIC_SQL)
def top_organic(spark, sf_dir):
    return K.top_keywords_by_traffic(organic_facts(Tables(spark, sf_dir)), k=10)
