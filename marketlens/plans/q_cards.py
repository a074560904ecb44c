"""Figures of scraped pages, one query a page type."""

from __future__ import annotations

from ..operators import cards as C
from ..sources.fixtures import raw_pages_df, ref_rows_df, views_then
from ..sources.tables import Tables
from .oracle_sql import parse_number_sql as P
from .oracle_sql import q
from .q_typing import FL, S
from .registry import register


def _texts(kind: str, names=(), strip: bool = True) -> str:
    named = f" and x.name in ({', '.join(q(n) for n in names)})" if names else ""
    return f"list_transform(list_filter(elements, lambda x: x.kind = {q(kind)}{named}), lambda x: {S('x.text') if strip else 'x.text'})"


def _said(texts: str) -> str:
    return f"list_filter({texts}, lambda x: length(x) > 0)"


def _page(page_type: str) -> str:
    return f"from raw_pages_v where page_type = {q(page_type)}"


def _register(name: str, ids: str, sql: str, operator, rows: bool = False):
    def build(spark, sf_dir):
        t = Tables(spark, sf_dir)
        return operator((ref_rows_df if rows else raw_pages_df)(t))

    build.__name__ = name
    register(name, ids, views_then(sql, "raw_cards_v", "ref_rows_v" if rows else "raw_pages_v"))(build)


_exact = {k: v for code, label in C.INTENTS for k, v in ((code, label), (label.lower(), label))}
_keys = ", ".join(q(k) for k in _exact)
_label = " ".join(f"when {q(k)} then {q(v)}" for k, v in _exact.items())
_guess = " ".join(f"when contains(lower(x), {q(code.lower())}) then {q(label)}" for code, label in C.INTENTS)


def _field(names) -> str:
    return "coalesce(" + ", ".join(f"nullif(({_texts('field', [n])})[1], '')" for n in reversed(names)) + ")"


_register("card_keyword_overview", "C-02", f"""
t as (select client_id, subject, {", ".join(f"{P(_field(n))} as {f}0" for f, n in C.KEYWORD_FIELDS.items())},
             {_said(_texts('card'))} as cards, {_texts('gauge')} as gauges, {_texts('intent')} as intents {_page('keyword_overview')}),
u as (select *, list_filter(list_transform(gauges, lambda x: {P('x')}), lambda x: x > 0 and x <= 100)[1] as gauge,
             list_filter(intents, lambda x: x in ({_keys}))[1] as known,
             list_filter(list_transform(intents, lambda x: case {_guess} end), lambda x: x is not null)[-1] as guess from t)
select client_id, subject, case when volume0 = 0 and len(cards) >= 1 then {P('cards[1]')} else volume0 end as volume,
       case when kd0 = 0 then coalesce(gauge, 0.0) else kd0 end as kd,
       case when volume0 = 0 and len(cards) >= 3 then {P('cards[3]')} else cpc0 end as cpc,
       coalesce(case known {_label} end, guess, 'Unknown') as intent from u""", C.keyword_overview)


_groups = ", ".join(f"case when len(g{k}) > 0 then g{k} end" for k in range(len(C.LOOKUP_CARDS)))
_register("card_keyword_lookup", "C-05", f"""
t as (select client_id, subject, {", ".join(f"{_said(_texts('card', n, False))} as g{k}" for k, n in enumerate(C.LOOKUP_CARDS))} {_page('keyword_lookup')}),
u as (select *, coalesce({_groups}) as v from t)
select client_id, subject, v[1] as volume_raw, v[2] as cpc_raw, v[3] as competition_raw from u""", C.keyword_lookup)


_figures = ", ".join(f"case when {f}0 = 0 then coalesce({P(f'cards[{k + 1}]')}, 0.0) else {f}0 end as {f}" for k, f in enumerate(C.BACKLINK_FIELDS))
_fields = ", ".join(P(f"({_texts('field', [n])})[1]") + f" as {f}0" for f, n in C.BACKLINK_FIELDS.items())
_register("card_backlink_overview", "C-07", f"""
t as (select client_id, subject, {_fields}, {_said(_texts('card'))} as cards {_page('backlink_overview')})
select client_id, subject, {_figures} from t""", C.backlink_overview_cards)


def _first_number(kind: str, gate: str) -> str:
    return f"coalesce(list_filter(list_transform({_texts(kind)}, lambda x: {P('x')}), lambda x: {gate})[1], 0.0)"


_register("referring_domain_rows", "C-09,X-10", f"""
t as (select *, list_filter(list_transform(cells[1:3], lambda c: {FL('c')}), lambda x: contains(x, '.') and length(x) > 3)[1] as ref_domain
      from ref_rows_v where len(cells) >= 2)
select client_id, subject, row_seq, ref_domain, {_first_number('authority', 'x > 0 and x <= 100')} as authority_score,
       {_first_number('backlinks', 'x > 0')} as backlinks from t where ref_domain <> ''""", C.referring_domain_rows, True)


_register("card_ai_overview", "C-10,F-05", f"""
t as (select client_id, subject, {_said(_texts('card'))} as cards, list_filter({_texts('platform')}, lambda x: length(x) > 1) as platforms
      {_page('ai_overview')})
select client_id, subject, {P('cards[1]')} as ai_visibility_score, {P('cards[2]')} as ai_mentions, {P('cards[3]')} as prompts_tracked, platforms
from t""", C.ai_overview)


_register("card_brand_performance", "C-12", f"""
t as (select client_id, subject, {_said(_texts('card'))} as cards {_page('brand_performance')})
select client_id, subject, cards[1:10] as raw_metrics from t""", C.brand_performance)


_register("card_growth_actions", "C-12,F-05", f"""
t as (select client_id, subject, list_filter({_texts('action')}, lambda x: length(x) > 5) as actions {_page('growth_actions')})
select client_id, subject, cast(i - 1 as integer) as action_seq, actions[i] as action
from (select *, unnest(range(1, len(actions) + 1)) as i from t)""", C.growth_actions)
