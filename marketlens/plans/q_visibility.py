"""AI-visibility queries: triggers, counts, recommendations, prompts,
prompt counts, brand mentions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import TRIGGER_LIKELIHOOD
from ..operators import visibility as V
from ..sources.fixtures import ask_keywords_df, brands_df, clients_df, paid_kw_df, views_then, with_views
from ..sources.tables import Tables
from .oracle_sql import dround_sql, q, trigger_sql
from .registry import register


def _classified(t):
    return V.classify_triggers(t.documents.select("doc_id", "text"), "text")


TRIGGER_CLASSES_SQL = f"select doc_id, {trigger_sql('text')} as trigger_category from documents"


@register("trigger_classes", "I-02", TRIGGER_CLASSES_SQL)
def trigger_classes(spark, sf_dir):
    return _classified(Tables(spark, sf_dir)).select("doc_id", "trigger_category")


def _dim_sql() -> str:
    return " union all ".join(f"select {q(c)} as trigger_category, {i + 1} as cat_order, {q(lab)} as likelihood"
                              for i, (c, lab) in enumerate(TRIGGER_LIKELIHOOD))


TRIGGER_COUNTS_SQL = f"""
with c as (select {trigger_sql('text')} as trigger_category from documents),
dim as ({_dim_sql()})
select d.cat_order, d.trigger_category, d.likelihood, count(c.trigger_category) as n_keywords
from dim d left join c on c.trigger_category = d.trigger_category
group by d.cat_order, d.trigger_category, d.likelihood"""


@register("trigger_counts", "A-09", TRIGGER_COUNTS_SQL)
def trigger_counts(spark, sf_dir):
    return V.trigger_counts(_classified(Tables(spark, sf_dir)))


def _rec_sql() -> str:
    rows = " union all ".join(
        f"select {i + 1} as rec_order, {q(p)} as priority, {q(a)} as action, {q(r)} as reason_tpl, "
        f"{q(c) if c else 'cast(null as varchar)'} as trigger_category"
        for i, (p, a, r, c) in enumerate(V.RECOMMENDATIONS))
    tools = q(" | ".join(V.RECOMMENDATION_TOOLS))
    return views_then(f"""c as (select client_id, seq, keyword, {trigger_sql('keyword')} as trigger_category from ask_kw_v),
n as (select client_id, trigger_category, count(*) as n from c group by 1, 2),
f5 as (select client_id, trigger_category, string_agg(keyword, ' | ' order by seq) as keywords
       from (select *, row_number() over (partition by client_id, trigger_category order by seq) as r from c)
       where r <= {V.MAX_REC_KEYWORDS} group by 1, 2),
tpl as ({rows}),
rec as (select cl.client_id, tpl.* from (select distinct client_id from c) cl cross join tpl)
select rec.client_id, rec.rec_order, rec.priority, rec.action,
       case when rec.trigger_category is not null
            then replace(rec.reason_tpl, '{{n}}', cast(coalesce(n.n, 0) as varchar)) else rec.reason_tpl end as reason,
       case when rec.trigger_category is not null then coalesce(f5.keywords, '') end as keywords,
       case when rec.rec_order = {len(V.RECOMMENDATIONS)} then {tools} end as tools
from rec left join n on rec.client_id = n.client_id and rec.trigger_category = n.trigger_category
left join f5 on rec.client_id = f5.client_id and rec.trigger_category = f5.trigger_category""", "keyword_obs_v", "ask_kw_v")


def _asked(spark, sf_dir):
    return V.classify_triggers(ask_keywords_df(Tables(spark, sf_dir)))


@register("recommendations", "I-03", _rec_sql())
def recommendations(spark, sf_dir):
    return V.recommendations(_asked(spark, sf_dir), "seq", "keyword", by=("client_id",))


KEYWORD_TRIGGER_COUNTS_SQL = views_then(f"""c as (select client_id, {trigger_sql('keyword')} as trigger_category from ask_kw_v),
dim as ({_dim_sql()})
select cl.client_id, d.cat_order, d.trigger_category, d.likelihood, count(c.trigger_category) as n_keywords
from (select distinct client_id from c) cl cross join dim d
left join c on c.client_id = cl.client_id and c.trigger_category = d.trigger_category
group by all""", "keyword_obs_v", "ask_kw_v")


@register("keyword_trigger_counts", "A-09,I-02", KEYWORD_TRIGGER_COUNTS_SQL)
def keyword_trigger_counts(spark, sf_dir):
    return V.trigger_counts(_asked(spark, sf_dir), by=("client_id",))


def _prompt_inputs(t):
    c = clients_df(t)
    targets = c.filter(F.col("seq") == 0).select("client_id", F.col("name").alias("target_name"),
                                                 F.col("domain").alias("target"))
    # market keywords of a client: its target's paid keywords in page order
    wanted = targets.select("client_id", F.col("target").alias("domain"))
    kw = (paid_kw_df(t, max_position=5, domains=wanted).join(wanted, "domain")
          .select("client_id", F.col("position").alias("seq"), "keyword"))
    comps = c.filter(F.col("seq") > 0).select("client_id", "seq",
                                              F.coalesce("name", "domain").alias("name"))
    return targets.select("client_id", "target_name"), kw, comps


def _prompts_sql() -> str:
    parts = []
    for cat, order, feed, limit, tpls in V.PROMPT_TEMPLATES:
        for j, tpl in enumerate(tpls):
            expr = " || ".join(q(v) if k == "lit" else ("t" if v == "target" else "x")
                               for k, v in V.template_parts(tpl))
            src = {"target": "(select client_id, 0 as item_seq, t, null as x from tg)",
                   "keyword": "(select k.client_id, k.seq as item_seq, tg.t, k.keyword as x from kw k join tg on k.client_id = tg.client_id)",
                   "competitor": "(select c.client_id, c.seq as item_seq, tg.t, c.name as x from cp c join tg on c.client_id = tg.client_id)"}[feed]
            lim = f" where item_seq <= {limit}" if limit else ""
            parts.append(f"select client_id, {q(cat)} as category, {order} as cat_order, cast(item_seq as integer) as item_seq, "
                         f"{j + 1} as tpl_order, {expr} as prompt from {src}{lim}")
    return views_then("""tg as (select client_id, coalesce(name, '') as t, domain as target from clients_v where seq = 0),
kw as (select tg.client_id, p.position as seq, p.keyword from paid_kw_v p join tg on p.domain = tg.target where p.position <= 5),
cp as (select client_id, seq, coalesce(name, domain) as name from clients_v where seq > 0),
prompts as (""" + "\nunion all\n".join(parts) + ")", "clients_v", "paid_kw_v")


PROMPTS_SQL = _prompts_sql() + "\nselect * from prompts"


@register("prompts", "I-01,J-04", PROMPTS_SQL)
def prompts(spark, sf_dir):
    return V.build_prompts(*_prompt_inputs(Tables(spark, sf_dir)))


PROMPT_COUNTS_SQL = _prompts_sql() + """
select client_id, category, count(*) as n_prompts from prompts group by rollup (client_id, category)"""


@register("prompt_counts", "A-10", PROMPT_COUNTS_SQL)
def prompt_counts(spark, sf_dir):
    return V.prompt_counts(V.build_prompts(*_prompt_inputs(Tables(spark, sf_dir))))


BRAND_MENTIONS_SQL = views_then(f"""b as (select client_id, brand from brands_v where length(brand) > 0),
a as (select lower(text) as lt from conversations where role = 'assistant'),
h as (select b.client_id, b.brand, count(*) as answers_mentioning,
             sum(cast((length(a.lt) - length(replace(a.lt, lower(b.brand), ''))) / length(lower(b.brand)) as bigint)) as mentions
      from b join a on contains(a.lt, lower(b.brand)) group by 1, 2),
f as (select b.client_id, b.brand, coalesce(h.answers_mentioning, 0) as answers_mentioning,
             coalesce(h.mentions, 0) as mentions
      from b left join h on b.client_id = h.client_id and b.brand = h.brand)
select f.*, {dround_sql('case when sum(answers_mentioning) over (partition by client_id) > 0 then cast(answers_mentioning as double) / cast(sum(answers_mentioning) over (partition by client_id) as double) else 0.0 end', 6)} as share_of_voice,
       (select count(*) from conversations where role = 'user') as prompts_tracked
from f""", "clients_v", "brands_v")


@register("brand_mentions", "A-16", BRAND_MENTIONS_SQL)
def brand_mentions(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return V.brand_mentions(t.conversations, brands_df(t))
