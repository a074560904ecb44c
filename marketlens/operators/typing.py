"""Scraped table rows and metric cards -> typed rows (C-01 ... C-12, X-08 ...
X-12, F-04, F-05), as column expressions over ``array<string>`` cells.

Inputs: ``raw_rows(domain, row_seq, cells array<string>)`` and
``raw_cards(domain, values array<string>)``.  All work is narrow (higher-
order array functions per row); row caps are per-page windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import INTENT_CODES, INTENT_LABELS, clean_number_text, parse_clean, parse_number, py_strip, score_gate
from ..session import dealt


def _first(arr: Column) -> Column:
    return F.get(arr, 0)


def first_line(c: Column) -> Column:
    """X-08: first line of a stripped cell, stripped."""
    return py_strip(F.get(F.split(py_strip(c), "\n"), 0))


def first_keyword_cell(cells: Column, n: int = 3) -> Column:
    """X-09: first of the first ``n`` cells whose stripped text is longer
    than 2 characters and not all digits -> its first line."""
    ok = F.filter(F.slice(cells, 1, n),
                  lambda c: (F.length(py_strip(c)) > 2) & ~py_strip(c).rlike(r"^[0-9]+$"))
    return first_line(_first(ok))


def first_domain_cell(cells: Column, n: int = 3, strip_line: bool = True) -> Column:
    """X-10: first of the first ``n`` cells whose first line contains a dot
    and is longer than 3 characters."""
    def fl(c):
        line = F.get(F.split(py_strip(c), "\n"), 0)
        return py_strip(line) if strip_line else line
    ok = F.filter(F.slice(cells, 1, n), lambda c: fl(c).contains(".") & (F.length(fl(c)) > 3))
    return fl(_first(ok))


def first_url_cell(cells: Column, n: int = 2) -> Column:
    """X-11: first of the first ``n`` cells whose first line contains '/' or 'http'."""
    def fl(c):
        return F.get(F.split(py_strip(c), "\n"), 0)
    ok = F.filter(F.slice(cells, 1, n), lambda c: fl(c).contains("/") | fl(c).contains("http"))
    return fl(_first(ok))


def _lines(cells: Column) -> Column:
    return F.flatten(F.transform(cells, lambda c: F.transform(F.split(py_strip(c), "\n"), lambda l: py_strip(l))))


def _cap(df: DataFrame, k: int | None, by=("domain",), order: str = "row_seq") -> DataFrame:
    """The first ``k`` rows of every page; all rows, over all tasks, for None."""
    if k is None:
        return dealt(df)
    w = W.partitionBy(*by).orderBy(order)
    return df.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= k).drop("__r")


def keyword_rows(raw: DataFrame, volume_text: Column | None = None, kd_text: Column | None = None,
                 max_rows: int | None = None, page=("domain",)) -> DataFrame:
    """C-01: keyword table rows (>= 3 cells; the first ``max_rows`` of each
    ``page``, where a limit is given):
    keyword (X-09); CPC = the first '$' line that parses to non-zero;
    intent = the last line that is an intent code or label; volume when
    > 0 and KD in (0, 100] from their own elements (0 when absent)."""
    r = _cap(raw, max_rows, page).filter(F.size("cells") >= 3).withColumn("__lines", _lines(F.col("cells")))
    lines = F.col("__lines")
    # every '$' line parsed once; the first non-zero value is the CPC
    dollars = F.filter(F.transform(lines, lambda l: F.when(l.contains("$"), parse_number(l))),
                       lambda x: x.isNotNull() & (x != 0))
    intents = F.filter(lines, lambda l: l.isin(*INTENT_CODES, *INTENT_LABELS))
    last_int = F.get(intents, F.size(intents) - 1)
    intent = F.coalesce(
        F.when(last_int.isin(*INTENT_LABELS), last_int),
        *[F.when(last_int == k, F.lit(v)) for k, v in INTENT_CODES.items()], F.lit("Unknown"))
    vol = score_gate(parse_number(volume_text), None) if volume_text is not None else F.lit(0.0)
    kd = score_gate(parse_number(kd_text), 100.0) if kd_text is not None else F.lit(0.0)
    out = r.select("domain", "row_seq", first_keyword_cell(F.col("cells")).alias("keyword"),
                   vol.alias("volume"), kd.alias("kd"),
                   F.coalesce(_first(dollars), F.lit(0.0)).alias("cpc"), intent.alias("intent"))
    return out.filter(F.col("keyword").isNotNull() & (F.col("keyword") != ""))


def paid_rows(raw: DataFrame, max_rows: int | None = None, page=("domain",)) -> DataFrame:
    """C-04: paid keyword rows with >= 5 cells by fixed position (the first
    ``max_rows`` rows of each ``page``, where a limit is given), kept when the
    keyword is non-empty."""
    r = (raw if max_rows is None else _cap(raw, max_rows, page)).filter(F.size("cells") >= 5)
    c = F.col("cells")
    return r.select("domain", "row_seq", F.get(c, 0).alias("keyword"), F.get(c, 1).alias("position"),
                    F.get(c, 2).alias("volume"), F.get(c, 3).alias("cpc"),
                    F.get(c, 4).alias("traffic_pct")).filter(F.col("keyword") != "")


def link_rows(raw: DataFrame, max_rows: dict | None = None, table: str | None = None, page=("domain",)) -> DataFrame:
    """C-09: typed backlink-table rows (>= 2 cells), one output row per (table
    kind, raw row) in a long format.  ``max_rows`` limits a table kind to the
    first rows of each ``page``, kind by kind; all rows where it has no entry.

    * ``referring_domains``: key = first of the first three cells whose
      first line holds a dot and is longer than 3 characters (X-10);
    * ``anchors``: key = first non-empty first line of the first two cells
      (X-08), metrics = first two positive numbers of the other cells (X-12);
    * ``top_pages``: key = first of the first two cells whose first line
      holds '/' or 'http' (X-11), metrics = first two positive numbers of
      all cells.

    Rows without a key are dropped, per table.  ``table`` restricts the
    output to one kind.
    """
    limits = max_rows or {}
    if limits:
        r = raw.withColumn("__r", F.row_number().over(W.partitionBy(*page).orderBy("row_seq")))
    else:
        r = dealt(raw)
    r = r.filter(F.size("cells") >= 2)
    # every cell's first line cut, stripped and cleaned once, in projections of their own
    r = r.withColumn("__f", F.transform("cells", lambda x: F.substring_index(py_strip(x), "\n", 1)))
    r = r.withColumns({"__l": F.transform("__f", lambda x: py_strip(x)),
                       "__p": F.transform(F.transform("__f", lambda x: clean_number_text(x)), lambda x: parse_clean(x))})
    lines = F.col("__l")
    domain = _first(F.filter(F.slice(lines, 1, 3), lambda x: x.contains(".") & (F.length(x) > 3)))
    url = _first(F.filter(F.slice("__f", 1, 2), lambda x: x.contains("/") | x.contains("http")))
    anchor = _first(F.filter(F.slice(lines, 1, 2), lambda x: F.length(x) > 0))
    nums_rest = F.filter(F.slice(F.col("__p"), F.lit(2), F.size("__p")), lambda v: v > 0)
    nums_all = F.filter(F.col("__p"), lambda v: v > 0)
    zero = F.lit(0.0)
    kinds = {
        "referring_domains": (domain, zero, zero),
        "anchors": (anchor, F.coalesce(F.get(nums_rest, 0), zero), F.coalesce(F.get(nums_rest, 1), zero)),
        "top_pages": (url, F.coalesce(F.get(nums_all, 0), zero), F.coalesce(F.get(nums_all, 1), zero)),
    }
    if table is not None:
        kinds = {table: kinds[table]}
    # one generator over the (<= 3) table kinds: a single pass over the rows
    def within(k, key):
        return F.when(F.col("__r") <= limits[k], key) if k in limits else key
    structs = F.array(*[F.struct(F.lit(k).alias("table"), within(k, key).alias("item"), n1.alias("referring_domains"),
                                 n2.alias("backlinks")) for k, (key, n1, n2) in kinds.items()])
    out = r.select("domain", "row_seq", F.explode(structs).alias("t")).select("domain", "row_seq", "t.*")
    return out.filter(F.col("item").isNotNull() & (F.col("item") != ""))


def ai_rows(raw: DataFrame, max_competitors: int | None = None, max_prompts: int | None = None,
            page=("domain",)) -> DataFrame:
    """C-11: AI competitor rows (domain from the first two cells, first five
    cells kept) and prompt rows (first cell longer than 5 characters, first
    four cells kept), each the first rows of a ``page`` where a limit is
    given; F-04, F-05."""
    gate = F.size("cells") >= 2
    c = F.col("cells")
    strip_all = lambda a: F.transform(a, lambda x: py_strip(x))
    if max_competitors is None and max_prompts is None:
        pages = prompts = dealt(raw)  # one exchange, read by both
    else:
        pages, prompts = _cap(raw, max_competitors, page), _cap(raw, max_prompts, page)
    comp = pages.filter(gate).select(
        "domain", "row_seq", F.lit("competitor").alias("row_kind"),
        first_domain_cell(c, 2, strip_line=False).alias("value"),
        F.array_join(strip_all(F.slice(c, 1, 5)), " | ").alias("raw_data")).filter(F.col("value").isNotNull())
    prm = prompts.filter(gate).select(
        "domain", "row_seq", F.lit("prompt").alias("row_kind"), py_strip(F.get(c, 0)).alias("value"),
        F.array_join(strip_all(F.slice(c, 1, 4)), " | ").alias("raw_data")).filter(F.length("value") > 5)
    return comp.unionByName(prm)


def typed_cards(cards: DataFrame) -> DataFrame:
    """Metric cards by position (C-02, C-05, C-07, C-10, C-12): non-empty
    stripped card values, then
    keyword overview: volume = v0, cpc = v2 (>= 3 values);
    keyword CPC lookup: raw volume / cpc / competition = v0..v2;
    backlinks: authority, total, referring domains, referring IPs = v0..v3;
    AI overview: score, mentions, prompts tracked = v0..v2;
    brand performance: the first ten raw values.
    Each position is parsed once (a projection of its own) and reused."""
    v = F.filter(F.transform(F.col("values"), lambda x: py_strip(x)), lambda x: F.length(x) > 0)
    staged = cards.select("domain", v.alias("v")).select(
        "domain", "v", F.size("v").alias("n"),
        *[parse_number(F.get(F.col("v"), i)).alias(f"p{i}") for i in range(4)])
    num = lambda i: F.when(F.col("n") > i, F.col(f"p{i}")).otherwise(F.lit(0.0))
    return staged.select(
        "domain",
        num(0).alias("kw_volume"),
        F.when(F.col("n") >= 3, F.col("p2")).otherwise(F.lit(0.0)).alias("kw_cpc"),
        F.get(F.col("v"), 0).alias("lookup_volume_raw"), F.get(F.col("v"), 1).alias("lookup_cpc_raw"),
        F.get(F.col("v"), 2).alias("lookup_competition_raw"),
        num(0).alias("authority_score"), num(1).alias("total_backlinks"),
        num(2).alias("referring_domains"), num(3).alias("referring_ips"),
        num(0).alias("ai_visibility_score"), num(1).alias("ai_mentions"), num(2).alias("prompts_tracked"),
        F.array_join(F.slice(F.col("v"), 1, 10), " | ").alias("raw_metrics"))


def link_type_split(elements: DataFrame, by=("domain",)) -> DataFrame:
    """C-08: link-type figures from labelled elements (label = element plus
    parent text, lower-cased; value = element text), checked per element as
    an if/elif chain in page order:

    1. label contains 'nofollow' and value > 0 -> nofollow (last wins);
    2. label contains 'follow' and value > 0 and follow not yet set ->
       follow (so the *first* such element wins; 'nofollow' never gets
       here, the substring trap);
    3. label contains 'text' and value > 0 -> text (last wins);
    4. label contains 'image' and value > 0 -> image (last wins).

    Elements per page are few, so one window per domain marks the first
    follow candidate; the figures are ``max_by`` / ``min_by`` aggregates.
    """
    lab = F.lower(F.col("label"))
    val = parse_number(F.col("value_text"))
    e = elements.select(*by, "el_seq", lab.alias("__l"), val.alias("__v"))
    b1 = F.col("__l").contains("nofollow") & (F.col("__v") > 0)
    cand = ~b1 & F.col("__l").contains("follow") & (F.col("__v") > 0)
    first_follow = F.min(F.when(cand, F.col("el_seq"))).over(W.partitionBy(*by))
    e = e.withColumn("__b1", b1).withColumn("__b2", cand & (F.col("el_seq") == first_follow))
    b3 = ~F.col("__b1") & ~F.col("__b2") & F.col("__l").contains("text") & (F.col("__v") > 0)
    b4 = ~F.col("__b1") & ~F.col("__b2") & ~b3 & F.col("__l").contains("image") & (F.col("__v") > 0)
    e = e.withColumn("__b3", b3).withColumn("__b4", b4)
    pick_last = lambda flag: F.max_by(F.when(F.col(flag), F.col("__v")),
                                      F.when(F.col(flag), F.col("el_seq")))
    return e.groupBy(*by).agg(
        F.coalesce(pick_last("__b1"), F.lit(0.0)).alias("nofollow_links"),
        F.coalesce(pick_last("__b2"), F.lit(0.0)).alias("follow_links"),
        F.coalesce(pick_last("__b3"), F.lit(0.0)).alias("text_links"),
        F.coalesce(pick_last("__b4"), F.lit(0.0)).alias("image_links"))
