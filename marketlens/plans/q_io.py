"""Readers, payload documents and exports over files that are written from
the shared tables, with records that can't be read among them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dashboard as D
from ..operators import keywords as K
from ..operators import links as L
from ..operators import visibility as V
from ..session import ensure_checkpoint_dir
from ..sources import settings as S
from ..sources import sinks
from ..sources.fixtures import clients_df, keyword_obs_df, links_df, reviews_df, views_then, with_views
from ..sources.tables import Tables
from .q_dashboard import _ROLES, DASHBOARD_BACKLINKS_SQL, DASHBOARD_KEYWORDS_SQL, DASHBOARD_TARGET_SQL
from .q_links import _FACTS, backlink_roles
from .q_paid import INDUSTRY_AVERAGES_SQL, industry_averages_df
from .q_visibility import _prompt_inputs, _prompts_sql
from .registry import register


def _folder(spark, name: str) -> str:
    """A new folder beside the checkpoints, which every machine sees."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _lines(df: DataFrame, name: str) -> str:
    path = _folder(df.sparkSession, name)
    df.select("value").write.text(path)
    return path


# -- settings: a client per supplier; lines cut short, lines of a wrong type, blank lines
SETTINGS_SQL = """settings as (
  select 'client' || s_suppkey as client_id, s_suppkey as k, case when s_suppkey % 6 > 0 then s_name end as name,
         case when s_suppkey % 9 = 0 then null when s_suppkey % 10 = 0 then '' else lower(s_name) || '.example' end as domain
  from supplier where s_suppkey % 7 not in (3, 5)),
rivals as (
  select client_id, cast(i as integer) as seq,
         case when (k + i) % 5 = 0 then '' when (k + i) % 7 = 0 then null else 'rival' || (k + i) || '.example' end as domain,
         case when (k + i) % 3 > 0 then 'Rival ' || (k + i) end as name, case when i = 1 then 'primary' end as priority
  from settings, (select unnest([1, 2, 3]) as i) where i <= k % 4)"""


def settings_path(t: Tables) -> str:
    k = F.col("s_suppkey")
    number = k.cast("string")
    target = F.struct(F.when(k % 6 > 0, F.col("s_name")).alias("name"),
                      F.when(k % 9 == 0, F.lit(None).cast("string")).when(k % 10 == 0, F.lit(""))
                      .otherwise(F.concat(F.lower("s_name"), F.lit(".example"))).alias("domain"))

    def rival(i):
        j = k + i
        return F.struct(F.when(j % 5 == 0, F.lit("")).when(j % 7 == 0, F.lit(None).cast("string"))
                        .otherwise(F.concat(F.lit("rival"), j.cast("string"), F.lit(".example"))).alias("domain"),
                        F.when(j % 3 > 0, F.concat(F.lit("Rival "), j.cast("string"))).alias("name"),
                        F.when(i == 1, F.lit("primary")).alias("priority"))

    rivals = F.when(k % 4 > 0, F.transform(F.sequence(F.lit(1), F.greatest(k % 4, F.lit(1))), rival))
    name = F.concat(F.lit("client"), number).alias("client_id")
    document = F.to_json(F.struct(name, target.alias("target"), rivals.alias("competitors")))
    odd = F.concat(F.lit('{"client_id":"client'), number, F.lit('","competitors":"none"}'))
    value = F.when(k % 7 == 3, F.substring(document, 1, 20)).when(k % 7 == 5, odd).otherwise(document)
    lines = t.supplier.select(F.explode(F.array(value, F.when(k % 11 == 0, F.lit("  ")))).alias("value")).filter("value is not null")
    return _lines(lines, "settings")


@register("settings_domains", "S-01,S-02,U-03", f"with {SETTINGS_SQL}" + """
select client_id, 0 as seq, domain, 'target' as role from settings where domain <> ''
union all select client_id, seq, domain, 'competitor' from rivals where domain <> ''""")
def settings_domains(spark, sf_dir):
    return S.all_domains(S.read_settings(spark, settings_path(Tables(spark, sf_dir))))


@register("settings_competitors", "S-01,S-03,F-01", f"with {SETTINGS_SQL}" + """
select client_id, seq, domain, name, coalesce(priority = 'primary', false) as is_primary from rivals""")
def settings_competitors(spark, sf_dir):
    comps = S.competitors(S.read_settings(spark, settings_path(Tables(spark, sf_dir))))
    names = S.competitor_names(comps).filter("domain <> ''").withColumnRenamed("name", "mapped")
    first = S.primary_competitors(comps).select("client_id", "seq", F.lit(True).alias("is_primary"))
    rows = comps.select("client_id", "seq", "domain", "name").join(names, ["client_id", "domain"], "left").join(first, ["client_id", "seq"], "left")
    return rows.select("client_id", "seq", "domain", F.coalesce("mapped", "name").alias("name"),
                       F.coalesce("is_primary", F.lit(False)).alias("is_primary"))


@register("settings_rejected", "S-01", """
select '{"client_id":"client' || s_suppkey || '","competitors":"none"}' as document from supplier where s_suppkey % 7 = 5
union all select left('{"client_id":"client' || s_suppkey || '"' || repeat(',', 20), 20) from supplier where s_suppkey % 7 = 3""")
def settings_rejected(spark, sf_dir):
    return S.rejected_settings(spark, settings_path(Tables(spark, sf_dir))).select("document")


# -- reviews: lines cut short, ratings that are no number
def reviews_path(t: Tables) -> str:
    k = F.col("review_seq")
    good = F.to_json(F.struct("review_seq", "brand", "location", "rating", "text"))
    odd = F.to_json(F.struct("review_seq", "brand", F.lit("five").alias("rating"), "text"))
    value = F.when(k % 13 == 4, F.concat(F.lit('{"review_seq":'), k.cast("string"), F.lit(',"brand')))
    return _lines(reviews_df(t).select(value.when(k % 17 == 3, odd).otherwise(good).alias("value")), "reviews")


@register("review_reader", "S-04", with_views("""
select review_seq, brand, location, rating, length(text)::bigint as n_chars, sha256(coalesce(text, '')) as text_sha256
from reviews_v where review_seq % 13 <> 4 and review_seq % 17 <> 3""", "reviews_v"))
def review_reader(spark, sf_dir):
    r = sinks.read_reviews(spark, reviews_path(Tables(spark, sf_dir)))
    return r.select("review_seq", "brand", "location", "rating", F.length("text").cast("long").alias("n_chars"),
                    F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


@register("reviews_rejected", "S-04", with_views("""
select review_seq::varchar as review_seq, review_seq % 13 = 4 as cut_short
from reviews_v where review_seq % 13 = 4 or review_seq % 17 = 3""", "reviews_v"))
def reviews_rejected(spark, sf_dir):
    _, bad = sinks.read_reviews_checked(spark, reviews_path(Tables(spark, sf_dir)))
    return bad.select(F.regexp_extract("document", '"review_seq":([0-9]+)', 1).alias("review_seq"),
                      (~F.col("document").endswith("}")).alias("cut_short"))


@register("benchmark_reader", "S-05,S-08", f"select client_id, avg_cpc from ({INDUSTRY_AVERAGES_SQL})")
def benchmark_reader(spark, sf_dir):
    path = sinks.write_json(industry_averages_df(spark, sf_dir), _folder(spark, "averages"), ("client_id",))
    return S.read_benchmark(spark, path)


# -- payload documents -------------------------------------------------------
@register("keyword_payload", "S-06,D-01", f"""
with e as ({DASHBOARD_KEYWORDS_SQL}),
k as (select client_id, count(*) as n_keywords, sha256(string_agg(keyword || '=' || intent, '|' order by keyword)) as keywords_sha256,
             sum(volume) as volume, sum(kd) as kd from e group by 1),
c as ({views_then('''x as (select client_id, domain, arg_max(coalesce(name, domain), seq) as name, arg_max(coalesce(priority, 'secondary'), seq) as priority
             from clients_v where seq > 0 and domain <> '' group by 1, 2)
select client_id, sha256(string_agg(domain || '=' || name || '/' || priority, '|' order by domain)) as competitors_sha256, count(*) as n_competitors
from x group by 1''', 'clients_v')})
select client_id, 1 as part, 1 as parts, 'marketlens' as source, coalesce(n_keywords, 0) as n_keywords,
       coalesce(keywords_sha256, sha256('')) as keywords_sha256, coalesce(volume, 0.0) as volume, coalesce(kd, 0.0) as kd,
       coalesce(n_competitors, 0) as n_competitors, coalesce(competitors_sha256, sha256('')) as competitors_sha256
from k full join c using (client_id)""")
def keyword_payload(spark, sf_dir):
    t = Tables(spark, sf_dir)
    entries = D.keyword_map(K.parse_metrics(keyword_obs_df(t)), by=("client_id",))
    docs = D.keyword_payload(entries, clients_df(t).filter("seq > 0"), as_of="2025-01-01 00:00:00")
    word, rival = F.map_entries("keywords"), F.map_entries("competitors")
    said = F.array_join(F.transform(word, lambda x: F.concat(x["key"], F.lit("="), x["value"]["intent"])), "|")
    rivals = F.array_join(F.transform(rival, lambda x: F.concat(x["key"], F.lit("="), x["value"]["name"], F.lit("/"), x["value"]["priority"])), "|")
    total = lambda c: F.aggregate(F.map_values("keywords"), F.lit(0.0), lambda s, x: s + x[c]).alias(c)
    return docs.select("client_id", "part", "parts", "source", F.size("keywords").cast("long").alias("n_keywords"),
                       F.sha2(said, 256).alias("keywords_sha256"), total("volume"), total("kd"),
                       F.size("competitors").cast("long").alias("n_competitors"), F.sha2(rivals, 256).alias("competitors_sha256"))


def _profiles(t: Tables) -> DataFrame:
    facts = L.normalise_link_facts(links_df(t))
    # no vendor authority score in the tables: referring domains stand in
    ov = L.backlink_overview(facts).withColumn("authority_score", F.col("referring_domains"))
    return D.backlink_profiles(backlink_roles(facts), ov, L.top_pages(facts, 30), L.anchors(facts, 30), L.referring_domains(facts, 50))


@register("backlink_profiles", "S-07", views_then(_FACTS + ",\n" + _ROLES + """,
x as (select * from facts where src_host <> target_host),
n as (select target_host, count(*) as total_backlinks, least(count(distinct target_path), 30) as n_pages, least(count(distinct anchor), 30) as n_anchors,
             least(count(distinct regexp_extract(src_host, '([^.]+\\.[^.]+)$', 1)), 50) as n_domains from x group by 1)
select client_id, seq, domain, coalesce(total_backlinks, 0) as total_backlinks, coalesce(n_pages, 0) as n_pages, coalesce(n_anchors, 0) as n_anchors,
       coalesce(n_domains, 0) as n_domains from roles left join n on domain = target_host""", "links_v"))
def backlink_profiles(spark, sf_dir):
    size = lambda c, name: F.size(c).cast("long").alias(name)
    return _profiles(Tables(spark, sf_dir)).select(
        "client_id", "seq", "domain", F.coalesce("overview.total_backlinks", F.lit(0)).alias("total_backlinks"), size("top_pages", "n_pages"),
        size("top_anchors", "n_anchors"), size("top_referring_domains", "n_domains"))


@register("backlink_payload", "D-02,K-06,K-07,S-07", f"""
with c as ({DASHBOARD_BACKLINKS_SQL}), s as ({DASHBOARD_TARGET_SQL}),
a as (select client_id, max(case when is_target then domain end) as target_domain,
             string_agg(domain || ':' || is_target || ':' || total_backlinks || ':' || referring_domains || ':' || follow_links || ':' || nofollow_links,
                        '|' order by rank) as comparison from c group by 1),
b as (select client_id, string_agg(item || ':' || backlinks, '|' order by rank) filter (where section = 'top_pages') as pages,
             string_agg(item || ':' || backlinks, '|' order by rank) filter (where section = 'top_anchors') as anchors,
             string_agg(item || ':' || backlinks, '|' order by rank) filter (where section = 'referring_domains') as domains from s group by 1)
select client_id, target_domain, comparison, coalesce(pages, '') as pages, coalesce(anchors, '') as anchors, coalesce(domains, '') as domains
from a left join b using (client_id)""")
def backlink_payload(spark, sf_dir):
    docs = D.backlink_payload(_profiles(Tables(spark, sf_dir)), as_of="2025-01-01 00:00:00")
    figures = ("total_backlinks", "referring_domains", "follow_links", "nofollow_links")
    text = lambda c: c.cast("string")
    joined = lambda c, key: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x[key], text(x["backlinks"]))), "|")
    return docs.select("client_id", "target_domain", F.array_join(F.transform("comparison", lambda x: F.concat_ws(
        ":", x["domain"], text(x["is_target"]), *[text(x[c]) for c in figures])), "|").alias("comparison"),
        joined("target_top_pages", "target_path").alias("pages"), joined("target_top_anchors", "anchor").alias("anchors"),
        joined("target_referring_domains", "ref_domain").alias("domains"))


# -- export: all clients, then one client again -------------------------------
AGAIN = "NATION_1"


@register("dashboard_export", "S-14,S-15", f"""
with kw as ({DASHBOARD_KEYWORDS_SQL}), bl as ({DASHBOARD_BACKLINKS_SQL}), cl as ({with_views('select * from clients_v', 'clients_v')}),
files as (select client_id, 'keyword_market_data' as dataset, count(*) as n_rows from kw group by 1
          union all select client_id, 'backlink_data', count(*) from bl group by 1
          union all select client_id, 'competitor_benchmarks', count(*) from cl group by 1)
select client_id, case when client_id = '{AGAIN}' then 2 else 1 end::bigint as version, 'marketlens' as source, dataset, n_rows
from files where client_id <> '{AGAIN}' or dataset = 'keyword_market_data'""")
def dashboard_export(spark, sf_dir):
    t = Tables(spark, sf_dir)
    facts = L.normalise_link_facts(links_df(t))
    ov = L.backlink_overview(facts).withColumn("authority_score", F.col("referring_domains"))
    keywords = K.parse_metrics(keyword_obs_df(t))
    data = {"keyword_intelligence_full": keywords, "backlink_data": D.backlink_comparison(ov, backlink_roles(facts)),
            "competitor_paid_summary": clients_df(t), "notes": clients_df(t)}
    out = _folder(spark, "export")
    how = {"transforms": {"keyword_market_data": lambda df: D.keyword_map(df, by=("client_id",))}, "as_of": "2025-01-01 00:00:00",
           "formats": sinks.DASHBOARD_FORMATS, "alternates": sinks.ALTERNATE_SOURCES}
    sinks.export_dashboard(data, [*sinks.DASHBOARD_FORMATS, "notes", "unknown"], out, **how)
    sinks.export_dashboard({"keyword_intelligence_full": keywords.filter(F.col("client_id") == AGAIN)}, ["keyword_market_data"], out, **how)
    return sinks.read_manifest(spark, out).select("client_id", "version", "source", F.explode("files").alias("f")).select(
        "client_id", "version", "source", "f.dataset", F.col("f.rows").alias("n_rows"))


# -- prompts by category, empty ones too ----------------------------------------
PROMPT_CATEGORY_COUNTS_SQL = _prompts_sql() + f""",
said as (select p.* from prompts p join nation on client_id = n_name
         where not (category = 'comparison' and n_nationkey % 5 = 2) and not (category in ('how_to', 'cost', 'recommendation', 'category_discovery') and n_nationkey % 5 = 3)),
every as (select n_name as client_id, category from nation, (select unnest({list(dict.fromkeys(t[0] for t in V.PROMPT_TEMPLATES))!r}) as category)),
full_ as (select client_id, category, count(prompt) as n from every left join said using (client_id, category) group by 1, 2)
select client_id, category, sum(n)::bigint as n_prompts from full_ group by rollup (client_id, category)"""


@register("prompt_category_counts", "A-10", PROMPT_CATEGORY_COUNTS_SQL)
def prompt_category_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    targets, kw, comps = _prompt_inputs(t)
    # clients without competitors, clients without keywords, and clients without a target
    turn = t.nation.select(F.col("n_name").alias("client_id"), (F.col("n_nationkey") % 5).alias("turn"))
    without = lambda df, k: df.join(turn.filter(F.col("turn") == k), "client_id", "left_anti")
    return V.prompt_counts(V.build_prompts(targets, without(kw, 3), without(comps, 2)), clients=turn.select("client_id"))
