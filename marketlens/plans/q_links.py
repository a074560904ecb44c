"""Link queries: extracted page links, backlink profiles and gap."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import links as L
from ..functions.urls import ENTITIES
from ..sources.fixtures import linked_pages_df, links_df, suffix_links_df, suffix_rules_df, views_then, with_views
from ..operators.ranking import global_row_number
from ..sources.tables import Tables
from .registry import register

_HOST = "lower(regexp_extract({}, '(?i)^https?://([^/?#:]+)', 1))"
_REG = "regexp_extract({}, '([^.]+\\.[^.]+)$', 1)"


def _attr_sql(name: str) -> str:
    double, single, bare = f'"([^"]*)"', "''([^'']*)''", "([^\\s>\"'']+)"
    find = "regexp_extract(tag, '(?is)\\s{0}\\s*=\\s*(?:{1}|{2}|{3})', {4})"
    return " || ".join(find.format(name, double, single, bare, k) for k in (1, 2, 3))


PAGE_LINKS_CTE = f"""el as (select page_id, {_HOST.format('url')} as src_host, url,
              unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*>.*?</a>', 0)) as el,
              generate_subscripts(regexp_extract_all(html, '(?is)<a\\s[^>]*>.*?</a>', 0), 1) - 1 as link_pos
       from pages),
f0 as (select *, regexp_extract(el, '(?is)^<a\\s[^>]*>', 0) as tag from el),
f as (select *, {_attr_sql('href')} as href, lower({_attr_sql('rel')}) as rel,
             regexp_extract(el, '(?is)^<a\\s[^>]*>(.*)</a>$', 1) as inner_html from f0),
page_links as (select page_id, cast(link_pos as integer) as link_pos, src_host, url as src_url, href,
       case when regexp_matches(href, '(?i)^https?://') then {_HOST.format('href')}
            when href[1:2] = '//' then {_HOST.format("('http:' || href)")}
            when regexp_matches(tag, '(?i)\\shref\\s*=') and not regexp_matches(href, '(?i)^[a-z][a-z0-9+.-]*:') then src_host
            end as target_host,
       case when regexp_matches(href, '(?i)^https?://') then regexp_extract(href, '(?i)^https?://[^/?#]+(.*)$', 1)
            when href[1:2] = '//' then regexp_extract('http:' || href, '^http://[^/?#]+(.*)$', 1)
            else href end as target_path,
       regexp_replace(regexp_replace(inner_html, '<[^>]*>', '', 'g'), '^\\s+|\\s+$', '', 'g') as anchor,
       contains(rel, 'nofollow') as nofollow, contains(lower(inner_html), '<img') as has_img
from f)"""

PAGE_LINKS_SQL = "with " + PAGE_LINKS_CTE + "\nselect * from page_links"


def _page_links(spark, sf_dir):
    return L.extract_links(Tables(spark, sf_dir).pages)


@register("page_links", "L-01", PAGE_LINKS_SQL)
def page_links(spark, sf_dir):
    return _page_links(spark, sf_dir)


def _overview_sql(src: str, internal: bool) -> str:
    where = "where target_host is not null" if internal else "where src_host <> target_host"
    return f"""select target_host, count(*) as total_backlinks,
       count(distinct {_REG.format('src_host')}) as referring_domains,
       count(distinct src_host) as referring_hosts,
       count_if(not nofollow) as follow_links, count_if(nofollow) as nofollow_links,
       count_if(not has_img) as text_links, count_if(has_img) as image_links
from {src} {where} group by target_host"""


PAGE_LINK_OVERVIEW_SQL = "with " + PAGE_LINKS_CTE + "\n" + _overview_sql("page_links", True)


@register("page_link_overview", "L-01,A-11", PAGE_LINK_OVERVIEW_SQL)
def page_link_overview(spark, sf_dir):
    # the stored pages only link inside their own sites
    return L.backlink_overview(_page_links(spark, sf_dir), include_internal=True)


# -- links resolved against their base ---------------------------------------
def _decoded_sql(x: str) -> str:
    refs = f"list_distinct(regexp_extract_all({x}, '&#(?:[0-9]{{1,7}}|[xX][0-9A-Fa-f]{{1,6}});'))"
    code = "(case when lower(r[3]) = 'x' then cast('0x' || r[4:-2] as integer) else cast(r[3:-2] as integer) end)"
    out = f"list_reduce({refs}, lambda t, r: replace(t, r, chr({code})), {x})"
    for name, char in ENTITIES:
        quoted = char.replace("'", "''")
        out = f"replace({out}, '{name}', '{quoted}')"
    return out


_AUTH = "regexp_extract({}, '(?i)^[a-z][a-z0-9+.-]*://([^/?#]*)', 1)"
_PATH = "regexp_extract({}, '(?i)^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"


def _host_sql(url: str) -> str:
    return f"lower(regexp_extract({_AUTH.format(url)}, '^(?:[^@]*@)?([^:]*)', 1))"


def _dots_sql(path: str) -> str:
    kept = (f"list_reduce(string_split({path}, '/')[2:], lambda o, s: case when s = '.' then o "
            f"when s = '..' then regexp_replace(o, '/[^/]*$', '') else o || '/' || s end, '')")
    shut = f"case when regexp_matches({path}, '/\\.\\.?$') then '/' else '' end"
    return f"coalesce(nullif({kept} || {shut}, ''), '/')"


def _resolve_sql(base: str, href: str) -> str:
    ref = f"regexp_replace(regexp_replace({href}, '[\\t\\r\\n]', '', 'g'), '^[\\x00-\\x20]+|[\\x00-\\x20]+$|#.*$', '', 'g')"
    scheme = f"regexp_extract({base}, '^([A-Za-z]+):', 1)"
    site = f"{scheme} || '://' || {_AUTH.format(base)}"
    path, query = f"regexp_extract({ref}, '^([^?]*)', 1)", f"regexp_extract({ref}, '^[^?]*(\\?.*)?$', 1)"
    folder = f"regexp_replace(coalesce(nullif({_PATH.format(base)}, ''), '/'), '[^/]*$', '')"
    whole = f"(case when {ref}[1:2] = '//' then {scheme} || ':' || {ref} else {ref} end)"
    whole_path = f"coalesce(nullif({_PATH.format(whole)}, ''), '/')"
    full = (f"regexp_extract({whole}, '^([^:]+://)', 1) || {_AUTH.format(whole)} || "
            f"{_dots_sql(whole_path)} || regexp_extract({whole}, '^[^?]*(\\?.*)?$', 1)")
    return f"""case when regexp_matches({ref}, '(?i)^https?://') or {ref}[1:2] = '//' then {full}
      when regexp_matches({ref}, '^[A-Za-z][A-Za-z0-9+.-]*:') then null
      when {ref} = '' then regexp_replace({base}, '#.*$', '')
      when {ref}[1] = '?' then {site} || {_PATH.format(base)} || {ref}
      when {ref}[1] = '/' then {site} || {_dots_sql(path)} || {query}
      when {ref} is not null then {site} || {_dots_sql(f'({folder} || {path})')} || {query} end"""


RESOLVED_CTE = f"""p0 as (select page_id, url as src_url, string_split_regex(html, '(?i)<a\\s')[2:] as parts,
              regexp_extract(html, '(?is)<base(\\s[^>]*)>', 1) as tag from linked_pages_v),
p1 as (select page_id, src_url, parts, {_decoded_sql('(' + _attr_sql('href') + ')')} as base_href from p0),
p2 as (select page_id, src_url, parts, coalesce(case when base_href <> '' then {_resolve_sql('src_url', 'base_href')} end, src_url) as base from p1),
e0 as (select page_id, src_url, base, i - 1 as link_pos, ' ' || parts[i] as part
       from (select *, unnest(range(1, len(parts) + 1)) as i from p2)),
e1 as (select *, regexp_extract(part, '(?s)^((?:[^>"'']|"[^"]*"|''[^'']*'')*)>', 1) as tag from e0),
e2 as (select page_id, src_url, base, link_pos, tag, regexp_extract(substring(part, length(tag) + 2), '(?is)^(.*?)(?:</a\\s*>|\\z)', 1) as inner_html,
              case when regexp_matches(tag, '(?i)\\shref\\s*=') then {_decoded_sql('(' + _attr_sql('href') + ')')} end as href,
              lower({_attr_sql('rel')}) as rel from e1),
e3 as (select *, {_resolve_sql('base', 'href')} as target_url from e2),
resolved as (select page_id, cast(link_pos as integer) as link_pos, {_host_sql('src_url')} as src_host, src_url, href, target_url,
       coalesce(lower(regexp_extract(target_url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)),
                lower(regexp_extract(trim(href), '^([A-Za-z][A-Za-z0-9+.-]*):', 1)), '') as scheme,
       {_host_sql('target_url')} as target_host, {_PATH.format('target_url')} as target_path,
       regexp_replace(regexp_replace(inner_html, '<[^>]*>', '', 'g'), '^\\s+|\\s+$', '', 'g') as anchor,
       contains(rel, 'nofollow') as nofollow, contains(lower(inner_html), '<img') as has_img,
       coalesce({_host_sql('target_url')} <> {_host_sql('src_url')}, false) as external
from e3)"""


@register("resolved_links", "L-01", views_then(RESOLVED_CTE + "\nselect * from resolved", "linked_pages_v"))
def resolved_links(spark, sf_dir):
    return L.resolve_links(linked_pages_df(Tables(spark, sf_dir)))


@register("resolved_link_overview", "L-01,A-11", views_then(RESOLVED_CTE + "\n" + _overview_sql("resolved", False), "linked_pages_v"))
def resolved_link_overview(spark, sf_dir):
    return L.backlink_overview(L.resolve_links(linked_pages_df(Tables(spark, sf_dir))))


# -- referring domains by public-suffix rules --------------------------------
SUFFIX_CTE = """hosts as (select distinct src_host, string_split(regexp_replace(lower(src_host), '\\.$', ''), '.') as labels from suffix_links_v),
asked as (select src_host, labels, i, array_to_string(labels[-i:], '.') as suffix
          from (select *, unnest(range(1, len(labels) + 1)) as i from hosts)),
met as (select src_host, bool_or(rule[1] = '!') as has_exception,
               max(case when rule[1] = '!' then i - 1 end) as exception_labels,
               max(case when rule[1:2] = '*.' then i + 1 when rule[1] <> '!' then i end) as plain_labels
        from asked join suffix_rules_v on suffix = regexp_replace(rule, '^(\\*\\.|!)', '')
        where rule[1:2] <> '*.' or i < len(labels) group by 1),
named as (select h.src_host, len(labels) as n, labels,
                 1 + coalesce(case when has_exception then exception_labels else plain_labels end, 1) as k
          from hosts h left join met on h.src_host = met.src_host),
dom as (select src_host, case when regexp_full_match(array_to_string(labels, '.'), '[0-9]{1,3}(\\.[0-9]{1,3}){3}') then array_to_string(labels, '.')
                              when n >= k then array_to_string(labels[-k:], '.') end as ref_domain from named),
facts as (select l.src_host, dom.ref_domain, target_host, target_path, anchor, coalesce(contains(lower(rel), 'nofollow'), false) as nofollow, has_img
          from suffix_links_v l join dom on dom.src_host = l.src_host where l.src_host <> target_host)"""
_SUFFIX_VIEWS = ("links_v", "suffix_links_v", "suffix_rules_v")


def _suffix_facts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return L.normalise_link_facts(suffix_links_df(t)), suffix_rules_df(t)


@register("suffix_ref_domains", "A-12", views_then(SUFFIX_CTE + """,
a as (select target_host, ref_domain, count(*) as backlinks from facts group by 1, 2)
select * from (select *, cast(row_number() over (partition by target_host order by backlinks desc, ref_domain nulls first)
               as integer) as rank from a) where rank <= 50""", *_SUFFIX_VIEWS))
def suffix_ref_domains(spark, sf_dir):
    facts, rules = _suffix_facts(spark, sf_dir)
    return L.referring_domains(facts, k=50, suffixes=rules)


@register("suffix_backlink_overview", "A-11,A-12", views_then(SUFFIX_CTE + """
select target_host, count(*) as total_backlinks, count(distinct ref_domain) as referring_domains,
       count(distinct src_host) as referring_hosts, count_if(not nofollow) as follow_links, count_if(nofollow) as nofollow_links,
       count_if(not has_img) as text_links, count_if(has_img) as image_links
from facts group by target_host""", *_SUFFIX_VIEWS))
def suffix_backlink_overview(spark, sf_dir):
    facts, rules = _suffix_facts(spark, sf_dir)
    return L.backlink_overview(facts, suffixes=rules)


@register("suffix_anchors", "A-13,A-12", views_then(SUFFIX_CTE + """,
a as (select target_host, anchor, count(distinct ref_domain) as referring_domains, count(*) as backlinks from facts group by 1, 2)
select * from (select *, cast(row_number() over (partition by target_host
               order by referring_domains desc, backlinks desc, anchor) as integer) as rank from a) where rank <= 30""", *_SUFFIX_VIEWS))
def suffix_anchors(spark, sf_dir):
    facts, rules = _suffix_facts(spark, sf_dir)
    return L.anchors(facts, k=30, suffixes=rules)


_FACTS = """facts as (select src_host, target_host, target_path, anchor,
       coalesce(contains(lower(rel), 'nofollow'), false) as nofollow, has_img from links_v)"""


def _facts(spark, sf_dir):
    return L.normalise_link_facts(links_df(Tables(spark, sf_dir)))


BACKLINK_OVERVIEW_SQL = views_then(_FACTS + "\n" + _overview_sql("facts", False), "links_v")


@register("backlink_overview", "A-11,C-08", BACKLINK_OVERVIEW_SQL)
def backlink_overview(spark, sf_dir):
    return L.backlink_overview(_facts(spark, sf_dir))


REF_DOMAINS_SQL = views_then(_FACTS + f""",
a as (select target_host, {_REG.format('src_host')} as ref_domain, count(*) as backlinks
      from facts where src_host <> target_host group by 1, 2)
select * from (select *, cast(row_number() over (partition by target_host order by backlinks desc, ref_domain)
               as integer) as rank from a) where rank <= 50""", "links_v")


@register("ref_domains", "A-12", REF_DOMAINS_SQL)
def ref_domains(spark, sf_dir):
    return L.referring_domains(_facts(spark, sf_dir), k=50)


ANCHORS_SQL = views_then(_FACTS + f""",
a as (select target_host, anchor, count(distinct {_REG.format('src_host')}) as referring_domains,
             count(*) as backlinks from facts where src_host <> target_host group by 1, 2)
select * from (select *, cast(row_number() over (partition by target_host
               order by referring_domains desc, backlinks desc, anchor) as integer) as rank from a) where rank <= 30""",
                          "links_v")


@register("anchors", "A-13", ANCHORS_SQL)
def anchors(spark, sf_dir):
    return L.anchors(_facts(spark, sf_dir), k=30)


TOP_PAGES_SQL = views_then(_FACTS + f""",
a as (select target_host, target_path, count(distinct {_REG.format('src_host')}) as referring_domains,
             count(*) as backlinks from facts where src_host <> target_host group by 1, 2)
select * from (select *, cast(row_number() over (partition by target_host
               order by backlinks desc, referring_domains desc, target_path) as integer) as rank from a)
where rank <= 30""", "links_v")


@register("top_pages", "A-14", TOP_PAGES_SQL)
def top_pages(spark, sf_dir):
    return L.top_pages(_facts(spark, sf_dir), k=30)


def backlink_roles(facts):
    """Settings derived from the link table: all target hosts in order of
    name, five to a client: its target and four competitors."""
    hosts = global_row_number(facts.select("target_host").distinct(), [F.asc("target_host")], "n")
    n = F.col("n") - 1
    return hosts.select(F.concat(F.lit("links"), F.floor(n / 5).cast("string")).alias("client_id"),
                        (n % 5).alias("seq"), F.col("target_host").alias("domain"))


BACKLINK_GAP_SQL = views_then(_FACTS + """,
roles as (select 'links' || (n // 5) as client_id, n % 5 as seq, target_host as domain
          from (select target_host, row_number() over (order by target_host) - 1 as n
                from (select distinct target_host from facts))),
j as (select r.client_id, r.seq, f.src_host, f.target_host from facts f join roles r on f.target_host = r.domain
      where f.src_host <> f.target_host and r.seq <= 4),
a as (select client_id, src_host, bool_or(seq = 0) as to_target,
             count(distinct case when seq > 0 then target_host end) as n_competitors,
             count_if(seq > 0) as competitor_links from j group by 1, 2)
select client_id, src_host as ref_host, n_competitors, competitor_links from a
where not to_target and n_competitors > 0""", "links_v")


@register("backlink_gap", "J-09", BACKLINK_GAP_SQL)
def backlink_gap(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return L.backlink_gap(f, backlink_roles(f))
