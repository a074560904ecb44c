"""Dashboard reshaping (D-01, D-02, K-06, K-07, K-12, J-07, X-20)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Slice sizes of the dashboard payload.
TOP_PAGES, TOP_ANCHORS, TOP_REF_DOMAINS, KEYWORD_GAP_ROWS = 20, 20, 30, 50


def keyword_map(related: DataFrame, by=()) -> DataFrame:
    """D-01 (rebuild branch): one entry per lower-cased keyword of the
    related-keyword list, empty keywords skipped, the *last* occurrence
    winning (dictionary assignment), absent metrics defaulted (volume, kd,
    cpc 0; intent 'Unknown').  ``max_by`` aggregates map-side."""
    k = related.filter(F.col("keyword").isNotNull() & (F.col("keyword") != "")).select(
        *by, "seq", F.lower("keyword").alias("keyword"),
        F.struct(F.coalesce("volume", F.lit(0.0)).alias("volume"), F.coalesce("kd", F.lit(0.0)).alias("kd"),
                 F.coalesce("cpc", F.lit(0.0)).alias("cpc"),
                 F.coalesce("intent", F.lit("Unknown")).alias("intent")).alias("m"))
    return k.groupBy(*by, "keyword").agg(F.max_by("m", "seq").alias("m")).select(*by, "keyword", "m.*")


def keyword_map_column(entries: DataFrame, by=()) -> DataFrame:
    """The ``keywords`` map of the dashboard JSON: ``map_from_entries`` over
    the (bounded, per client) keyword entries, for the sink."""
    return entries.groupBy(*by).agg(F.map_from_entries(F.collect_list(
        F.struct("keyword", F.struct("volume", "kd", "cpc", "intent")))).alias("keywords"))


def gap_slice(gap: DataFrame, k: int = KEYWORD_GAP_ROWS, by=("client_id",)) -> DataFrame:
    """K-12: the first k keyword-gap rows per client (missing keywords,
    best competitor position first)."""
    w = W.partitionBy(*by).orderBy("best_position", "keyword")
    return (gap.filter(F.col("status") == "missing").withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k))


def backlink_comparison(overview: DataFrame, roles: DataFrame, authority: str = "authority_score",
                        by=("client_id",)) -> DataFrame:
    """D-02 / K-06: one row per profiled domain (target and competitors),
    ``is_target`` flag, counters defaulted to 0 (X-20), sorted by authority
    descending with ties in profile order (stable sort)."""
    j = roles.select(*by, "seq", F.col("domain")).join(
        overview.withColumnRenamed("target_host", "domain"), "domain", "left")
    cols = ["total_backlinks", "referring_domains", "follow_links", "nofollow_links"]
    out = j.select(*by, "seq", "domain", (F.col("seq") == 0).alias("is_target"),
                   F.coalesce(F.col(authority), F.lit(0)).cast("double").alias("authority_score"),
                   *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in cols])
    w = W.partitionBy(*by).orderBy(F.desc("authority_score"), "seq")
    return out.withColumn("rank", F.row_number().over(w)).drop("seq")


def target_slices(roles: DataFrame, pages: DataFrame, anchors: DataFrame, ref_domains: DataFrame,
                  by=("client_id",)) -> DataFrame:
    """D-02 / K-07 / J-07: the target's top pages (20), anchors (20) and
    referring domains (30) as one long table (section, rank, key, ...).
    A missing target profile yields no rows (an empty dict)."""
    t = roles.filter(F.col("seq") == 0).select(*by, F.col("domain").alias("target_host"))
    p = pages.filter(F.col("rank") <= TOP_PAGES).select(
        "target_host", F.lit("top_pages").alias("section"), "rank", F.col("target_path").alias("item"),
        "referring_domains", "backlinks")
    a = anchors.filter(F.col("rank") <= TOP_ANCHORS).select(
        "target_host", F.lit("top_anchors").alias("section"), "rank", F.col("anchor").alias("item"),
        "referring_domains", "backlinks")
    r = ref_domains.filter(F.col("rank") <= TOP_REF_DOMAINS).select(
        "target_host", F.lit("referring_domains").alias("section"), "rank", F.col("ref_domain").alias("item"),
        F.lit(None).cast("long").alias("referring_domains"), "backlinks")
    return t.join(p.unionByName(a).unionByName(r), "target_host").withColumnRenamed("target_host", "domain")


#: Keywords of one payload document; a client with more has several.
PART_KEYWORDS = 20_000


def keyword_payload(entries: DataFrame, competitors: DataFrame, by=("client_id",), part_keywords: int = PART_KEYWORDS,
                    source: str = "marketlens", as_of: str | None = None, gap: DataFrame | None = None) -> DataFrame:
    """S-06 / D-01: the keyword documents of every client: source, generated_at,
    ``keywords`` (keyword -> {volume, kd, cpc, intent}), ``competitors`` (domain
    -> {name, priority}, name defaulting to the domain, priority to
    'secondary'; the last entry of a repeated domain) and, with ``gap``
    (:func:`gap_slice`), ``keyword_gap``.

    The maps are in order of key.  A document holds about ``part_keywords``
    keywords: a client with more has several, numbered by ``part`` from 1 of
    ``parts``, dealt by hash so that no task orders all of a client's keywords;
    competitors and gap come with the first.  A client without keywords has one
    document with an empty map.  ``entries``: (by..., keyword, volume, kd, cpc,
    intent), one row per keyword; ``competitors``: (by..., seq, domain, name, priority).
    """
    stamp = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    total = entries.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / part_keywords).cast("int").alias("parts"))
    metrics = F.struct("volume", "kd", "cpc", "intent")
    dealt = entries.join(total, list(by)).select(*by, (F.pmod(F.xxhash64("keyword"), F.col("parts")) + 1).cast("int").alias("part"),
                                                 F.struct("keyword", metrics.alias("m")).alias("k"))
    docs = dealt.groupBy(*by, "part").agg(F.map_from_entries(F.array_sort(F.collect_list("k"))).alias("keywords"))
    last = competitors.filter(F.length("domain") > 0).groupBy(*by, "domain").agg(F.max_by(F.struct("name", "priority"), "seq").alias("c"))
    rivals = last.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("domain", F.struct(
        F.coalesce("c.name", "domain").alias("name"), F.coalesce("c.priority", F.lit("secondary")).alias("priority")))))).alias("competitors"))
    none = F.from_json(F.lit("{}"), "map<string, struct<volume: double, kd: double, cpc: double, intent: string>>")
    docs = docs.withColumn("__first", F.col("part") == 1)
    out = docs.join(rivals.withColumn("__first", F.lit(True)), [*by, "__first"], "full")
    columns = [F.coalesce("competitors", F.from_json(F.lit("{}"), "map<string, struct<name: string, priority: string>>")).alias("competitors")]
    if gap is not None:
        row = F.struct("rank", "keyword", "best_position", "n_competitors")
        slices = gap.groupBy(*by).agg(F.array_sort(F.collect_list(row)).alias("keyword_gap")).withColumn("__first", F.lit(True))
        out = out.join(slices, [*by, "__first"], "full")
        columns.append(F.coalesce("keyword_gap", F.array()).alias("keyword_gap"))
    one = F.lit(1)
    out = out.join(total, list(by), "left")
    return out.select(*by, F.coalesce("part", one).alias("part"), F.coalesce("parts", one).alias("parts"), F.lit(source).alias("source"),
                      stamp.alias("generated_at"), F.coalesce("keywords", none).alias("keywords"), *columns)


def backlink_profiles(roles: DataFrame, overview: DataFrame, pages: DataFrame, anchors: DataFrame, ref_domains: DataFrame,
                      by=("client_id",)) -> DataFrame:
    """S-07: the full profile of every domain of a client, one row per (client,
    domain): seq, overview, top_pages (the rows given, 30 of the source tool),
    top_anchors and top_referring_domains, each in order of rank.  A domain
    without backlinks has a null overview and empty lists."""
    def ranked(df: DataFrame, name: str, *cols: str) -> DataFrame:
        return df.groupBy("target_host").agg(F.array_sort(F.collect_list(F.struct("rank", *cols))).alias(name))

    counters = [c for c in overview.columns if c != "target_host"]
    out = roles.select(*by, "seq", "domain").join(
        overview.select(F.col("target_host").alias("domain"), F.struct(*counters).alias("overview")), "domain", "left")
    for part in (ranked(pages, "top_pages", "target_path", "referring_domains", "backlinks"),
                 ranked(anchors, "top_anchors", "anchor", "referring_domains", "backlinks"),
                 ranked(ref_domains, "top_referring_domains", "ref_domain", "backlinks")):
        out = out.join(part.withColumnRenamed("target_host", "domain"), "domain", "left")
    lists = ("top_pages", "top_anchors", "top_referring_domains")
    return out.select(*by, "seq", "domain", "overview", *[F.coalesce(c, F.array()).alias(c) for c in lists])


def backlink_payload(profiles: DataFrame, authority: str = "authority_score", by=("client_id",), as_of: str | None = None) -> DataFrame:
    """D-02: one document per client from its profiles: target_domain ('' where
    there is none), comparison (all profiles by authority descending, ties in
    order of seq, counters defaulting to 0) and the target's first pages (20),
    anchors (20) and referring domains (30).  As long as the client's list of
    competitors and no longer."""
    stamp = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    o = F.col("overview")
    whole = lambda c: F.coalesce(o.getField(c), F.lit(0)).cast("long").alias(c)
    points = F.coalesce(o.getField(authority), F.lit(0)).cast("double")
    entry = F.struct("domain", (F.col("seq") == 0).alias("is_target"), points.alias("authority_score"),
                     *[whole(c) for c in ("total_backlinks", "referring_domains", "follow_links", "nofollow_links")])
    target = F.col("seq") == 0
    docs = profiles.groupBy(*by).agg(
        F.coalesce(F.max(F.when(target, F.col("domain"))), F.lit("")).alias("target_domain"),
        F.array_sort(F.collect_list(F.struct((-points).alias("order"), "seq", entry.alias("entry")))).alias("c"),
        *[F.max_by(c, F.when(target, F.lit(1))).alias(c) for c in ("top_pages", "top_anchors", "top_referring_domains")])
    cut = {"top_pages": TOP_PAGES, "top_anchors": TOP_ANCHORS, "top_referring_domains": TOP_REF_DOMAINS}
    names = {"top_referring_domains": "target_referring_domains", "top_pages": "target_top_pages", "top_anchors": "target_top_anchors"}
    return docs.select(*by, stamp.alias("generated_at"), "target_domain", F.col("c.entry").alias("comparison"),
                       *[F.slice(F.coalesce(c, F.array()), 1, k).alias(names[c]) for c, k in cut.items()])


DASHBOARD_KEYWORD_COLUMNS = ("keyword", "volume", "kd", "cpc", "intent")


def transform_keyword_data(data: DataFrame) -> DataFrame:
    """D-01 dispatch: input already in dashboard shape (one row per keyword
    with metric columns, no list order) passes through unchanged;
    otherwise it is a related-keyword list (with ``seq``) and is rebuilt
    by :func:`keyword_map`.  Decided from the schema at plan time."""
    cols = set(data.columns)
    if "seq" not in cols and set(DASHBOARD_KEYWORD_COLUMNS) <= cols:
        return data.select(*DASHBOARD_KEYWORD_COLUMNS)
    return keyword_map(data)
