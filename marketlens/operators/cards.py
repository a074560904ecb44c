"""Scraped pages of named elements -> typed figures, one function a page type
(C-02, C-05, C-07, C-09, C-10, C-12, F-05).

Input: ``raw_pages(client_id, page_type, subject, elements VARIANT)``.  The
elements are a JSON array in page order of {kind, name, text, parent}: ``field``
(a named value), ``card`` (an unnamed one), ``gauge``, ``intent``,
``platform``, ``action``, ``authority``, ``backlinks``.  VARIANT keeps pages of
every layout in one table; a page whose elements aren't such an array has no
element, and its figures are those of an empty page.  All work is narrow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import parse_number, py_strip
from .typing import first_domain_cell

PAGE = ("client_id", "subject")
_ELEMENTS = "array<struct<kind: string, name: string, text: string, parent: string>>"
# Names of the fields of a figure, the later one winning where both say something.
KEYWORD_FIELDS = {"volume": ("volume", "keyword-overview-volume"), "kd": ("keyword-difficulty", "kd"), "cpc": ("cpc", "keyword-overview-cpc")}
BACKLINK_FIELDS = {"authority_score": "authority-score", "total_backlinks": "backlinks",
                   "referring_domains": "referring-domains", "referring_ips": "referring-ips"}
# Intents by code and by word; a text that is neither goes by the first letter that it holds.
INTENTS = (("T", "Transactional"), ("C", "Commercial"), ("I", "Informational"), ("N", "Navigational"))
#: Card names from the most to the least particular; the first with a text counts.
LOOKUP_CARDS = (("keyword-overview",), ("keyword-overview", "report-card"), ("metric",))


def page_elements(pages: DataFrame, page_type: str, keep=PAGE) -> DataFrame:
    """(keep..., e): the elements of the pages of one type."""
    typed = F.try_variant_get("elements", "$", _ELEMENTS)
    return pages.filter(F.col("page_type") == page_type).select(*keep, F.coalesce(typed, F.array().cast(_ELEMENTS)).alias("e"))


def _texts(kind: str, names=None, strip: bool = True) -> Column:
    """Texts of the elements of a kind, in page order."""
    some = F.filter("e", lambda x: (x["kind"] == kind) & (x["name"].isin(*names) if names else F.lit(True)))
    return F.transform(some, lambda x: py_strip(F.coalesce(x["text"], F.lit(""))) if strip else F.coalesce(x["text"], F.lit("")))


def _said(texts: Column) -> Column:
    return F.filter(texts, lambda x: F.length(x) > 0)


def _numbers(texts: Column) -> Column:
    return F.transform(texts, lambda x: parse_number(x))


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def _intent(texts: Column) -> Column:
    """The first text that is a code or word; else the last that holds a code's
    letter; else Unknown."""
    exact = {k: v for code, label in INTENTS for k, v in ((code, label), (label.lower(), label))}
    known = F.get(F.filter(texts, lambda x: x.isin(*exact)), 0)
    named = F.coalesce(*[F.when(known == k, F.lit(v)) for k, v in exact.items()])

    def guess(x: Column) -> Column:
        out = F.lit(None).cast("string")
        for code, label in reversed(INTENTS):
            out = F.when(F.lower(x).contains(code.lower()), F.lit(label)).otherwise(out)
        return out

    guesses = F.filter(F.transform(texts, guess), lambda x: x.isNotNull())
    return F.coalesce(named, F.get(guesses, F.size(guesses) - 1), F.lit("Unknown"))


def keyword_overview(pages: DataFrame) -> DataFrame:
    """C-02: volume, KD, CPC and intent of a keyword's page.  Named fields
    first; without a volume the cards say it (the first) and the CPC (the
    third, where there are three); without a KD the first gauge in (0, 100]."""
    e = page_elements(pages, "keyword_overview")
    # the first element of every name, where it says anything; the last name wins
    named = {f: F.coalesce(*[F.nullif(F.get(_texts("field", [n]), 0), F.lit("")) for n in reversed(names)]) for f, names in KEYWORD_FIELDS.items()}
    staged = e.select(*PAGE, *[_zero(parse_number(c)).alias(f"__{f}") for f, c in named.items()],
                      _numbers(F.slice(_said(_texts("card")), 1, 3)).alias("__cards"),
                      _numbers(_texts("gauge")).alias("__gauges"), _intent(_texts("intent")).alias("intent"))
    silent, cards = F.col("__volume") == 0, F.col("__cards")
    gauge = F.get(F.filter("__gauges", lambda x: (x > 0) & (x <= 100)), 0)
    return staged.select(
        *PAGE, F.when(silent & (F.size(cards) >= 1), F.get(cards, 0)).otherwise(F.col("__volume")).alias("volume"),
        F.when(F.col("__kd") == 0, _zero(gauge)).otherwise(F.col("__kd")).alias("kd"),
        F.when(silent & (F.size(cards) >= 3), F.get(cards, 2)).otherwise(F.col("__cpc")).alias("cpc"), "intent")


def keyword_lookup(pages: DataFrame) -> DataFrame:
    """C-05: raw volume, CPC and competition of a keyword: the first three
    texts of the most particular cards that say anything; null where absent."""
    groups = [_said(_texts("card", names, strip=False)) for names in LOOKUP_CARDS]
    values = F.coalesce(*[F.when(F.size(g) > 0, g) for g in groups])
    return page_elements(pages, "keyword_lookup").select(*PAGE, values.alias("v")).select(
        *PAGE, *[F.get("v", k).alias(f"{name}_raw") for k, name in enumerate(("volume", "cpc", "competition"))])


def backlink_overview_cards(pages: DataFrame) -> DataFrame:
    """C-07: four figures by name; one that is still 0 comes from the card at
    its place, where there is one."""
    e = page_elements(pages, "backlink_overview")
    staged = e.select(*PAGE, *[_zero(parse_number(F.get(_texts("field", [n]), 0))).alias(f) for f, n in BACKLINK_FIELDS.items()],
                      _numbers(F.slice(_said(_texts("card")), 1, len(BACKLINK_FIELDS))).alias("__cards"))
    return staged.select(*PAGE, *[F.when(F.col(f) == 0, _zero(F.get("__cards", k))).otherwise(F.col(f)).alias(f)
                                  for k, f in enumerate(BACKLINK_FIELDS)])


def referring_domain_rows(rows: DataFrame) -> DataFrame:
    """C-09: referring-domain rows of two cells and more with a domain (X-10),
    authority score (the first in (0, 100]) and backlinks (the first above 0),
    0 where absent.  ``rows``: (client_id, subject, row_seq, cells, elements)."""
    e = rows.withColumn("page_type", F.lit("row")).filter(F.size("cells") >= 2)
    e = page_elements(e, "row", (*PAGE, "row_seq", "cells"))
    authority = F.filter(_numbers(_texts("authority")), lambda x: (x > 0) & (x <= 100))
    backlinks = F.filter(_numbers(_texts("backlinks")), lambda x: x > 0)
    out = e.select(*PAGE, "row_seq", first_domain_cell(F.col("cells")).alias("ref_domain"),
                   _zero(F.get(authority, 0)).alias("authority_score"), _zero(F.get(backlinks, 0)).alias("backlinks"))
    return out.filter(F.col("ref_domain") != "")


def ai_overview(pages: DataFrame) -> DataFrame:
    """C-10, F-05: score, mentions and prompts tracked from the first cards, and
    the platforms named in more than one character, in page order."""
    e = page_elements(pages, "ai_overview").select(
        *PAGE, _numbers(F.slice(_said(_texts("card")), 1, 3)).alias("n"),
        F.filter(_texts("platform"), lambda x: F.length(x) > 1).alias("platforms"))
    return e.select(*PAGE, _zero(F.get("n", 0)).alias("ai_visibility_score"), _zero(F.get("n", 1)).alias("ai_mentions"),
                    _zero(F.get("n", 2)).alias("prompts_tracked"), "platforms")


def brand_performance(pages: DataFrame, k: int = 10) -> DataFrame:
    """C-12: the first ``k`` card texts as they are."""
    return page_elements(pages, "brand_performance").select(*PAGE, F.slice(_said(_texts("card")), 1, k).alias("raw_metrics"))


def growth_actions(pages: DataFrame) -> DataFrame:
    """C-12, F-05: a row for every action text of more than five characters."""
    texts = F.filter(_texts("action"), lambda x: F.length(x) > 5)
    return (page_elements(pages, "growth_actions").select(*PAGE, F.posexplode_outer(texts).alias("action_seq", "action"))
            .filter(F.col("action").isNotNull()))
