"""Link facts and backlink profiles (L-01, A-11 ... A-14, J-09, C-08).

Definitions (ours; the source tool only reads a vendor's pages):

* L-01: every ``<a ...>...</a>`` element of a page; ``href`` from its
  attribute; a relative href points at the page's own host; anchor = inner
  HTML with tags removed and whitespace stripped; nofollow = ``rel``
  contains "nofollow"; image link = inner HTML contains ``<img``.
* A-11 ... A-14: links whose source host equals the target host are
  internal and excluded unless ``include_internal=True``; referring domain
  = last two labels of the source host, referring host stands in for the
  referring IP; ties by key ascending.
* J-09: referring hosts that link to at least one competitor and not to
  the target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import urls as U
from ..functions.numbers import py_strip
from .keywords import first_competitors

HOST_RE = r"(?i)^https?://([^/?#:]+)"
ANCHOR_RE = r"(?is)<a\s[^>]*>.*?</a>"


def host_of(url) -> F.Column:
    c = F.col(url) if isinstance(url, str) else url
    return F.lower(F.regexp_extract(c, HOST_RE, 1))


def registered_domain(host) -> F.Column:
    c = F.col(host) if isinstance(host, str) else host
    return F.regexp_extract(c, r"([^.]+\.[^.]+)$", 1)


def _attribute(tag, name: str) -> F.Column:
    """Value of an attribute, double-quoted, single-quoted or bare."""
    pattern = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))"""
    return F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)])


def extract_links(pages: DataFrame) -> DataFrame:
    """L-01: one row per anchor element, in page order.  An element without
    href, or with one of another scheme (``mailto:``), has no target host.  One narrow pass
    (regex extraction + posexplode), no UDF; pages are independent, so the
    scan parallelises by file split."""
    el = pages.select("page_id", host_of("url").alias("src_host"), "url",
                      F.posexplode_outer(F.regexp_extract_all("html", F.lit(ANCHOR_RE), 0)).alias("link_pos", "el")
                      ).filter(F.col("el").isNotNull())
    tag = F.regexp_extract("el", r"(?is)^<a\s[^>]*>", 0)
    href = _attribute(tag, "href")
    rel = F.lower(_attribute(tag, "rel"))
    inner = F.regexp_extract("el", r"(?is)^<a\s[^>]*>(.*)</a>$", 1)
    absolute = href.rlike(r"(?i)^(https?:)?//")
    full = F.when(href.startswith("//"), F.concat(F.lit("http:"), href)).otherwise(href)
    nowhere = ~tag.rlike(r"(?i)\shref\s*=") | href.rlike(r"(?i)^[a-z][a-z0-9+.-]*:")
    return el.select(
        "page_id", "link_pos", "src_host", F.col("url").alias("src_url"), href.alias("href"),
        F.when(absolute, host_of(full)).when(~nowhere, F.col("src_host")).alias("target_host"),
        F.when(absolute, F.regexp_extract(full, r"(?i)^https?://[^/?#]+(.*)$", 1)).otherwise(href).alias("target_path"),
        py_strip(F.regexp_replace(inner, r"<[^>]*>", "")).alias("anchor"),
        rel.contains("nofollow").alias("nofollow"),
        F.lower(inner).contains("<img").alias("has_img"),
    )


def resolve_links(pages: DataFrame) -> DataFrame:
    """L-01 with full resolution: one row per anchor element in page order.

    An element starts at ``<a`` with attributes (without, it is no link) and ends at ``</a>``, at the next ``<a`` or at
    the end of the page, so an unclosed anchor doesn't swallow the next one;
    ``>`` in a quoted attribute doesn't end the tag.  Character references in
    ``href`` are decoded, and it is resolved (RFC 3986: dot segments, queries,
    ``//host``) against the first ``<base href>``, itself resolved against
    the page's URL.  ``scheme`` is that of the target, or of the reference
    where it is no web address (``mailto``), or '' without ``href``; such links
    have no target.  Null pages give no rows.  One narrow pass, no UDF.
    """
    tag_re = r"""(?s)^((?:[^>"']|"[^"]*"|'[^']*')*)>"""
    base_tag = F.regexp_extract("html", r"(?is)<base(\s[^>]*)>", 1)
    p = pages.select("page_id", F.col("url").alias("src_url"), F.slice(F.split("html", r"(?i)<a(?=\s)"), 2, 1 << 30).alias("parts"),
                     U.decode_entities(_attribute(base_tag, "href")).alias("base_href"))
    p = p.withColumn("base", F.when(F.col("base_href") != "", U.resolve(F.col("src_url"), F.col("base_href"))))
    el = p.select("page_id", "src_url", F.coalesce("base", "src_url").alias("base"),
                  F.posexplode_outer("parts").alias("link_pos", "part")).filter(F.col("part").isNotNull())
    el = el.withColumn("tag", F.regexp_extract("part", tag_re, 1))
    rest = F.substring(F.col("part"), F.length("tag") + 2, F.length("part"))
    el = el.select("page_id", "src_url", "base", "link_pos", "tag", F.regexp_extract(rest, r"(?is)^(.*?)(?:</a\s*>|\z)", 1).alias("inner"),
                   F.when(F.col("tag").rlike(r"(?i)\shref\s*="), U.decode_entities(_attribute(F.col("tag"), "href"))).alias("href"))
    el = el.withColumn("target_url", U.resolve(F.col("base"), F.col("href")))
    target = F.col("target_url")
    src = U.host(F.col("src_url"))
    return el.select(
        "page_id", "link_pos", src.alias("src_host"), "src_url", "href", "target_url",
        F.coalesce(F.when(target.isNotNull(), U.scheme_of(target)), U.scheme_of(F.col("href")), F.lit("")).alias("scheme"),
        U.host(target).alias("target_host"), U.path_of(target).alias("target_path"),
        py_strip(F.regexp_replace("inner", r"<[^>]*>", "")).alias("anchor"),
        F.lower(_attribute(F.col("tag"), "rel")).contains("nofollow").alias("nofollow"),
        F.lower("inner").contains("<img").alias("has_img"),
        F.coalesce(U.host(target) != src, F.lit(False)).alias("external"))


def normalise_link_facts(links: DataFrame) -> DataFrame:
    """Uniform link facts from the synthetic ``links_v`` shape."""
    return links.select("src_host", "target_host", "target_path", "anchor",
                        F.coalesce(F.lower("rel").contains("nofollow"), F.lit(False)).alias("nofollow"),
                        "has_img")


def _external(links: DataFrame, include_internal: bool, suffixes: DataFrame | None = None) -> DataFrame:
    """The links that count, with __domain: the registered domain of the source
    by the public-suffix rules given, else its last two labels."""
    l = links if include_internal else links.filter(F.col("src_host") != F.col("target_host"))
    if suffixes is None:
        return l.withColumn("__domain", registered_domain("src_host"))
    return U.with_registered_domain(l, "src_host", suffixes, "__domain")


def backlink_overview(links: DataFrame, include_internal: bool = False, suffixes: DataFrame | None = None) -> DataFrame:
    """A-11 / C-08: per target host: total links, referring domains,
    referring hosts (stand-in for IPs), follow / nofollow, text / image.
    One grouped aggregation with partial aggregation; distinct counts are
    exact (``approx_count_distinct`` is the drop-in at very large scale)."""
    l = _external(links.filter(F.col("target_host").isNotNull()), include_internal, suffixes)
    return l.groupBy("target_host").agg(
        F.count(F.lit(1)).alias("total_backlinks"),
        F.count_distinct("__domain").alias("referring_domains"),
        F.count_distinct("src_host").alias("referring_hosts"),
        F.count_if(~F.col("nofollow")).alias("follow_links"),
        F.count_if(F.col("nofollow")).alias("nofollow_links"),
        F.count_if(~F.col("has_img")).alias("text_links"),
        F.count_if(F.col("has_img")).alias("image_links"))


def _top(df: DataFrame, order, k: int) -> DataFrame:
    w = W.partitionBy("target_host").orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def referring_domains(links: DataFrame, k: int = 50, include_internal: bool = False, suffixes: DataFrame | None = None) -> DataFrame:
    """A-12: links per referring domain, top k per target (links desc).  With
    public-suffix rules (``suffixes``: (rule), see ``with_registered_domain``) a
    host that is itself a suffix is counted under a null domain."""
    l = _external(links, include_internal, suffixes).withColumn("ref_domain", F.col("__domain"))
    agg = l.groupBy("target_host", "ref_domain").agg(F.count(F.lit(1)).alias("backlinks"))
    return _top(agg, [F.desc("backlinks"), "ref_domain"], k)


def anchors(links: DataFrame, k: int = 30, include_internal: bool = False, suffixes: DataFrame | None = None) -> DataFrame:
    """A-13: referring domains and links per anchor text, top k per target
    (referring domains desc, links desc, anchor)."""
    l = _external(links, include_internal, suffixes)
    agg = l.groupBy("target_host", "anchor").agg(
        F.count_distinct("__domain").alias("referring_domains"),
        F.count(F.lit(1)).alias("backlinks"))
    return _top(agg, [F.desc("referring_domains"), F.desc("backlinks"), "anchor"], k)


def top_pages(links: DataFrame, k: int = 30, include_internal: bool = False, suffixes: DataFrame | None = None) -> DataFrame:
    """A-14: target pages by backlinks, top k per target host."""
    l = _external(links, include_internal, suffixes)
    agg = l.groupBy("target_host", "target_path").agg(
        F.count_distinct("__domain").alias("referring_domains"),
        F.count(F.lit(1)).alias("backlinks"))
    return _top(agg, [F.desc("backlinks"), F.desc("referring_domains"), "target_path"], k)


def backlink_gap(links: DataFrame, roles: DataFrame, by=("client_id",), max_competitors: int = 4,
                 include_internal: bool = False) -> DataFrame:
    """J-09: referring hosts linking to >= 1 of the first ``max_competitors``
    competitors (roles seq 1..) and not to the target (seq 0), with the
    number of competitors each links to.  One join on the target host and
    one aggregation; the target's referrers are removed by the aggregate
    predicate (an anti-join folded into the group)."""
    r = first_competitors(roles, by, max_competitors).select(*by, "seq", F.col("domain").alias("target_host"))
    j = _external(links, include_internal).select("src_host", "target_host").join(r, "target_host")
    agg = j.groupBy(*by, "src_host").agg(
        F.max(F.col("seq") == 0).alias("to_target"),
        F.count_distinct(F.when(F.col("seq") > 0, F.col("target_host"))).alias("n_competitors"),
        F.count_if(F.col("seq") > 0).alias("competitor_links"))
    return agg.filter(~F.col("to_target") & (F.col("n_competitors") > 0)).select(
        *by, F.col("src_host").alias("ref_host"), "n_competitors", "competitor_links")
