"""Row and card typing queries over the scraped-row / card views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import INTENT_CODES, INTENT_LABELS
from ..operators import typing as TY
from ..sources.fixtures import raw_cards_df, raw_rows_df, views_then, with_views
from ..sources.tables import Tables
from .oracle_sql import parse_number_sql as P
from .oracle_sql import q
from .registry import register


def S(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def FL(x: str) -> str:
    return S(f"string_split({S(x)}, chr(10))[1]")


# Rows that the tool reads of a page, by table.
PAGE_ROWS = {"keywords": 50, "paid": 10, "referring_domains": 50, "anchors": 30, "top_pages": 30,
             "ai_competitors": 20, "ai_prompts": 30}


def _rows_sql(src: str, gate: int, k: int | None) -> str:
    """Rows of ``src`` with at least ``gate`` cells; the first k of a page if k is given."""
    page = f" and rn <= {k}" if k is not None else ""
    return (f"(select * from (select *, row_number() over (partition by domain order by row_seq) as rn "
            f"from {src}) where len(cells) >= {gate}{page})")


def _gate100(x: str) -> str:
    return f"(case when {x} > 0 and {x} <= 100 then {x} else 0.0 end)"


def _pos(x: str) -> str:
    return f"(case when {x} > 0 then {x} else 0.0 end)"


_labels = ", ".join(q(x) for x in INTENT_LABELS)
_codes = ", ".join(q(x) for x in INTENT_CODES)
_map = " ".join(f"when li = {q(k)} then {q(v)}" for k, v in INTENT_CODES.items())

def _keyword_rows_sql(k: int | None) -> str:
    return views_then(f"""
r as {_rows_sql('raw_rows_v', 3, k)},
t as (select domain, row_seq, cells,
        flatten(list_transform(cells, lambda c: list_transform(string_split({S('c')}, chr(10)), lambda l: {S('l')}))) as lines
      from r),
u as (select *, list_filter(cells[1:3], lambda c: length({S('c')}) > 2 and not regexp_full_match({S('c')}, '[0-9]+'))[1] as kwc,
             list_filter(lines, lambda l: contains(l, '$') and {P('l')} <> 0)[1] as cpc_line,
             list_filter(lines, lambda l: l in ({_labels}, {_codes}))[-1] as li
      from t)
select domain, row_seq, {FL('kwc')} as keyword,
       {_pos(P('cells[4]'))} as volume, {_gate100(P('cells[1]'))} as kd,
       coalesce({P('cpc_line')}, 0.0) as cpc,
       case when li in ({_labels}) then li {_map} else 'Unknown' end as intent
from u where {FL('kwc')} is not null and {FL('kwc')} <> ''""", "raw_rows_v")


def _keyword_rows(spark, sf_dir, k=None):
    raw = raw_rows_df(Tables(spark, sf_dir))
    return TY.keyword_rows(raw, volume_text=F.get(F.col("cells"), 3), kd_text=F.get(F.col("cells"), 0), max_rows=k)


@register("typed_keyword_rows", "C-01,X-08,X-09,F-04", _keyword_rows_sql(None))
def typed_keyword_rows(spark, sf_dir):
    return _keyword_rows(spark, sf_dir)


@register("first_page_keyword_rows", "C-01", _keyword_rows_sql(PAGE_ROWS["keywords"]))
def first_page_keyword_rows(spark, sf_dir):
    return _keyword_rows(spark, sf_dir, PAGE_ROWS["keywords"])


def _paid_rows_sql(k: int | None) -> str:
    return views_then(f"""
r as {_rows_sql('raw_rows_v', 5, k)}
select domain, row_seq, cells[1] as keyword, cells[2] as position, cells[3] as volume, cells[4] as cpc,
       cells[5] as traffic_pct from r where cells[1] <> ''""", "raw_rows_v")


@register("typed_paid_rows", "C-04", _paid_rows_sql(None))
def typed_paid_rows(spark, sf_dir):
    return TY.paid_rows(raw_rows_df(Tables(spark, sf_dir)))


@register("first_page_paid_rows", "C-04", _paid_rows_sql(PAGE_ROWS["paid"]))
def first_page_paid_rows(spark, sf_dir):
    return TY.paid_rows(raw_rows_df(Tables(spark, sf_dir)), max_rows=PAGE_ROWS["paid"])


def _posnums(lst: str) -> str:
    return f"list_filter(list_transform({lst}, lambda c: {P(f'string_split({S(chr(99))}, chr(10))[1]')}), lambda v: v > 0)"


def _link_rows_sql(limits: dict) -> str:
    page = " or ".join(f"(\"table\" = {q(k)} and rn <= {n})" for k, n in limits.items()) or "true"
    return views_then(f"""
lv as (select domain, row_seq, cells from raw_rows_v
       union all
       select domain || '/url-first', row_seq, list_reverse(cells) from raw_rows_v),
r as {_rows_sql('lv', 2, None)},
t as (select domain, row_seq, rn, cells,
             list_filter(cells[1:3], lambda c: contains({FL('c')}, '.') and length({FL('c')}) > 3)[1] as dc,
             list_filter(list_transform(cells[1:2], lambda c: {FL('c')}), lambda x: length(x) > 0)[1] as anchor,
             {_posnums('cells[2:]')} as nr, {_posnums('cells')} as na,
             list_filter(cells[1:2], lambda c: contains(string_split({S('c')}, chr(10))[1], '/')
                                             or contains(string_split({S('c')}, chr(10))[1], 'http'))[1] as uc
      from r),
u as (select domain, row_seq, rn, 'referring_domains' as "table", {FL('dc')} as item,
             0.0 as referring_domains, 0.0 as backlinks from t
      union all
      select domain, row_seq, rn, 'anchors', anchor, coalesce(nr[1], 0.0), coalesce(nr[2], 0.0) from t
      union all
      select domain, row_seq, rn, 'top_pages', string_split({S('uc')}, chr(10))[1],
             coalesce(na[1], 0.0), coalesce(na[2], 0.0) from t)
select * exclude (rn) from u where item is not null and item <> '' and ({page})""", "raw_rows_v")


def _link_rows(spark, sf_dir, limits=None):
    # two table layouts: the scraped rows as they are, and URL-first pages
    raw = raw_rows_df(Tables(spark, sf_dir))
    url_first = raw.select(F.concat(F.col("domain"), F.lit("/url-first")).alias("domain"), "row_seq",
                           F.reverse("cells").alias("cells"))
    return TY.link_rows(raw.unionByName(url_first), max_rows=limits)


LINK_PAGE_ROWS = {k: PAGE_ROWS[k] for k in ("referring_domains", "anchors", "top_pages")}


@register("typed_link_rows", "C-09,X-10,X-11,X-12", _link_rows_sql({}))
def typed_link_rows(spark, sf_dir):
    return _link_rows(spark, sf_dir)


@register("first_page_link_rows", "C-09", _link_rows_sql(LINK_PAGE_ROWS))
def first_page_link_rows(spark, sf_dir):
    return _link_rows(spark, sf_dir, LINK_PAGE_ROWS)


def _ai_rows_sql(competitors: int | None, prompts: int | None) -> str:
    return views_then(f"""
rv as (select domain, row_seq, list_reverse(cells) as cells from raw_rows_v),
c as {_rows_sql('rv', 2, competitors)},
p as {_rows_sql('rv', 2, prompts)},
cc as (select domain, row_seq, 'competitor' as row_kind,
              string_split({S("list_filter(cells[1:2], lambda c: contains(string_split(" + S('c') + ", chr(10))[1], '.') and length(string_split(" + S('c') + ", chr(10))[1]) > 3)[1]")}, chr(10))[1] as value,
              array_to_string(list_transform(cells[1:5], lambda x: {S('x')}), ' | ') as raw_data from c),
pp as (select domain, row_seq, 'prompt' as row_kind, {S('cells[1]')} as value,
              array_to_string(list_transform(cells[1:4], lambda x: {S('x')}), ' | ') as raw_data from p)
select * from cc where value is not null
union all
select * from pp where length(value) > 5""", "raw_rows_v")


def _ai_rows(spark, sf_dir, competitors=None, prompts=None):
    # AI research tables lead with the domain / prompt: the scraped rows
    # reversed (URL first) stand in for them
    raw = raw_rows_df(Tables(spark, sf_dir))
    return TY.ai_rows(raw.select("domain", "row_seq", F.reverse("cells").alias("cells")), competitors, prompts)


@register("typed_ai_rows", "C-11,F-04,F-05", _ai_rows_sql(None, None))
def typed_ai_rows(spark, sf_dir):
    return _ai_rows(spark, sf_dir)


AI_PAGE_ROWS = (PAGE_ROWS["ai_competitors"], PAGE_ROWS["ai_prompts"])


@register("first_page_ai_rows", "C-11", _ai_rows_sql(*AI_PAGE_ROWS))
def first_page_ai_rows(spark, sf_dir):
    return _ai_rows(spark, sf_dir, *AI_PAGE_ROWS)


def _num(i: int) -> str:
    return f"(case when len(v) > {i} then {P(f'v[{i + 1}]')} else 0.0 end)"


CARDS_SQL = views_then(f"""
c as (select domain, list_filter(list_transform("values", lambda x: {S('x')}), lambda x: length(x) > 0) as v
      from raw_cards_v)
select domain, {_num(0)} as kw_volume,
       case when len(v) >= 3 then {P('v[3]')} else 0.0 end as kw_cpc,
       v[1] as lookup_volume_raw, v[2] as lookup_cpc_raw, v[3] as lookup_competition_raw,
       {_num(0)} as authority_score, {_num(1)} as total_backlinks, {_num(2)} as referring_domains,
       {_num(3)} as referring_ips, {_num(0)} as ai_visibility_score, {_num(1)} as ai_mentions,
       {_num(2)} as prompts_tracked, array_to_string(v[1:10], ' | ') as raw_metrics
from c""", "raw_cards_v")


@register("typed_cards", "C-02,C-05,C-07,C-10,C-12", CARDS_SQL)
def typed_cards(spark, sf_dir):
    return TY.typed_cards(raw_cards_df(Tables(spark, sf_dir)))


# Link-type elements of the backlink overview: every card value of a
# supplier becomes one labelled element, labels cycling through the widget
# captions (a 'nofollow' caption contains 'follow': the substring trap).
LINK_LABELS = ["follow links", "nofollow links", "text links", "image links", "follow"]


def link_elements_df(t):
    cards = raw_cards_df(t)
    labels = F.array(*[F.lit(x) for x in LINK_LABELS])
    return cards.select("domain", F.posexplode_outer("values").alias("el_seq", "value_text")).filter(
        F.col("value_text").isNotNull()).select(
        "domain", "el_seq", F.get(labels, F.col("el_seq") % len(LINK_LABELS)).alias("label"), "value_text")


def _link_types_sql() -> str:
    labels = "[" + ", ".join(q(x) for x in LINK_LABELS) + "]"
    return views_then(f"""
e0 as (select domain, cast(i - 1 as integer) as el_seq, "values"[i] as value_text
       from (select domain, "values", unnest(generate_series(1, len("values"))) as i from raw_cards_v)),
e as (select domain, el_seq, lower({labels}[el_seq % {len(LINK_LABELS)} + 1]) as l, {P('value_text')} as v from e0),
f as (select *, contains(l, 'nofollow') and v > 0 as b1,
             (not (contains(l, 'nofollow') and v > 0)) and contains(l, 'follow') and v > 0 as cand from e),
g as (select *, b1 is false and cand and el_seq = min(case when cand then el_seq end) over (partition by domain) as b2 from f),
h as (select *, not b1 and not b2 and contains(l, 'text') and v > 0 as b3 from g),
k as (select *, not b1 and not b2 and not b3 and contains(l, 'image') and v > 0 as b4 from h)
select domain,
       coalesce(arg_max(v, el_seq) filter (where b1), 0.0) as nofollow_links,
       coalesce(arg_max(v, el_seq) filter (where b2), 0.0) as follow_links,
       coalesce(arg_max(v, el_seq) filter (where b3), 0.0) as text_links,
       coalesce(arg_max(v, el_seq) filter (where b4), 0.0) as image_links
from k group by domain""", "raw_cards_v")


@register("typed_link_types", "C-08", _link_types_sql())
def typed_link_types(spark, sf_dir):
    return TY.link_type_split(link_elements_df(Tables(spark, sf_dir)))
