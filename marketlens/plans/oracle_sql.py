"""SQL fragments shared by the DuckDB oracles.

The oracles are independent SQL formulations of each query, generated from
the same fixed word lists the Spark expressions use.
"""

from __future__ import annotations

from ..functions.stopwords import ENGLISH_STOPWORDS
from ..functions.text import (COMPLAINT_CATEGORIES, OTHER_CATEGORY, SENTIMENT_NEGATIVE,
                              SENTIMENT_POSITIVE, TRIGGER_FALLBACK, TRIGGER_RULES)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def hits(col: str, terms) -> str:
    return " + ".join(f"cast(contains({col}, {q(t)}) as integer)" for t in terms)


def any_of(col: str, terms) -> str:
    return "(" + " or ".join(f"contains({col}, {q(t)})" for t in terms) + ")"


def scored_sql(src: str) -> str:
    """SELECT over ``src`` adding sentiment and category flags c0..c9."""
    flags = ",\n       ".join(f"coalesce({any_of('lt', terms)}, false) as c{i}"
                              for i, (_, terms) in enumerate(COMPLAINT_CATEGORIES))
    return f"""
select *, case when lt is null or npos+nneg=0 then 0.0
               else cast(npos-nneg as double)/cast(npos+nneg as double) end as sentiment
from (select *, {hits('lt', SENTIMENT_POSITIVE)} as npos, {hits('lt', SENTIMENT_NEGATIVE)} as nneg,
       {flags}
      from (select *, lower(text) as lt from {src}) a) b"""


def exploded_sql(src: str, cols: str = "review_seq") -> str:
    """One row per (review, category) with cat_idx = lexicon position."""
    parts = [f"select {cols}, {q(cat)} as category, {i} as cat_idx from {src} where c{i}"
             for i, (cat, _) in enumerate(COMPLAINT_CATEGORIES)]
    none = " or ".join(f"c{i}" for i in range(len(COMPLAINT_CATEGORIES)))
    parts.append(f"select {cols}, {q(OTHER_CATEGORY)} as category, {len(COMPLAINT_CATEGORIES)} as cat_idx "
                 f"from {src} where coalesce(lt, '') = '' or not ({none})")
    return "\nunion all\n".join(parts)


def label_sql(col: str) -> str:
    return f"upper(replace({col}, '_', ' '))"


def dround_sql(expr: str, n: int) -> str:
    return f"cast(round(cast({expr} as decimal(38,10)), {n}) as double)"


def trigger_sql(col: str) -> str:
    low = f"lower({col})"
    whens = " ".join(f"when {any_of(low, terms)} then {q(cat)}" for cat, terms in TRIGGER_RULES)
    return f"case {whens} else {q(TRIGGER_FALLBACK)} end"


def stopword_list_sql() -> str:
    return "[" + ", ".join(q(w) for w in ENGLISH_STOPWORDS) + "]"


def parse_number_sql(col: str) -> str:
    """DuckDB twin of ``parse_number`` as one scalar expression."""
    ws = "'^\\s+|\\s+$'"
    s = (f"regexp_replace(regexp_replace(regexp_replace(coalesce({col}, ''), {ws}, '', 'g'), "
         f"'[,$%–—]', '', 'g'), {ws}, '', 'g')")
    h = f"regexp_replace(left({s}, length({s}) - 1), {ws}, '', 'g')"
    last = f"upper(right({s}, 1))"
    flt = "'[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?'"
    return f"""(case
  when {s} = '' or {s} = '-' or lower({s}) = 'n/a' then 0.0
  when {last} in ('B', 'M', 'K') then coalesce(case when regexp_full_match({h}, {flt})
       then trunc(try_cast({h} as double) * case {last} when 'B' then 1e9 when 'M' then 1e6 else 1e3 end)
       end, 0.0)
  when contains({s}, '.') then coalesce(case when regexp_full_match({s}, {flt})
       then try_cast({s} as double) end, 0.0)
  else coalesce(case when regexp_full_match({s}, '[+-]?[0-9]+') then try_cast({s} as double) end, 0.0)
  end)"""
