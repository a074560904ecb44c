"""URL resolution, entities, links of odd pages, public suffixes."""

import html

import pytest
from pyspark.sql import functions as F

from marketlens.functions import urls as U
from marketlens.operators import links as L

# the reference examples of RFC 3986, 5.4 (fragments dropped)
RFC = {"g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g/", "?y": "http://a/b/c/d;p?y",
       "g?y": "http://a/b/c/g?y", "#s": "http://a/b/c/d;p?q", "g#s": "http://a/b/c/g", ";x": "http://a/b/c/;x", "": "http://a/b/c/d;p?q",
       ".": "http://a/b/c/", "./": "http://a/b/c/", "..": "http://a/b/", "../": "http://a/b/", "../g": "http://a/b/g", "../..": "http://a/",
       "../../g": "http://a/g", "../../../g": "http://a/g", "/./g": "http://a/g", "/../g": "http://a/g", "g.": "http://a/b/c/g.",
       "..g": "http://a/b/c/..g", "./../g": "http://a/b/g", "./g/.": "http://a/b/c/g/", "g/./h": "http://a/b/c/g/h", "g/../h": "http://a/b/c/h",
       "g;x=1/./y": "http://a/b/c/g;x=1/y", "mailto:x@y": None, "HTTPS://B/x/../y": "HTTPS://B/y", "  g\n": "http://a/b/c/g", None: None}


def test_resolution_as_in_the_rfc(spark):
    df = spark.createDataFrame([(k,) for k in RFC], "href string")
    got = {r.href: r.url for r in df.select("href", U.resolve(F.lit("http://a/b/c/d;p?q"), F.col("href")).alias("url")).collect()}
    assert got == RFC
    short = spark.createDataFrame([("x",), ("",), ("?q",)], "href string").select(U.resolve(F.lit("http://a"), F.col("href")).alias("u")).collect()
    assert [r.u for r in short] == ["http://a/x", "http://a", "http://a?q"]


def test_entities(spark):
    texts = ["a&amp;b", "&lt;&gt;&quot;&apos;", "&#65;&#x42;&#X43;&#128512;&#x1F600;", "&amp;lt;", "&unknown; & &#; &#xZZ;", "", None]
    got = [r.t for r in spark.createDataFrame([(t,) for t in texts], "t string").select(U.decode_entities(F.col("t")).alias("t")).collect()]
    assert got == [t if t is None or "unknown" in t else html.unescape(t) for t in texts]
    assert spark.range(1).select(U.decode_entities(F.lit("&#0;&#xD800;&#x110000;")).alias("t")).first().t == "�" * 3


def test_links_of_odd_pages(spark):
    pages = [(1, "https://a.com/x/y", '<base href="//b.com/z/"><a href="q">one <a href=/two rel="NOFOLLOW ugc">two</a>'
                                      '<a title=">" href=\'three\'><img></a><a name=n>none</a><a href="tel:1">call</a><a href="https://A.com">back'),
             (2, "https://a.com/", None), (3, "https://a.com/", ""), (4, None, '<a href="x">y</a>')]
    got = sorted(L.resolve_links(spark.createDataFrame(pages, "page_id long, url string, html string")).collect())
    brief = [(r.link_pos, r.target_url, r.scheme, r.anchor, r.nofollow, r.has_img, r.external) for r in got if r.page_id == 1]
    assert brief == [(0, "https://b.com/z/q", "https", "one", False, False, True), (1, "https://b.com/two", "https", "two", True, False, True),
                     (2, "https://b.com/z/three", "https", "", False, True, True), (3, None, "", "none", False, False, False),
                     (4, None, "tel", "call", False, False, False), (5, "https://A.com/", "https", "back", False, False, False)]
    assert [(r.page_id, r.target_url) for r in got if r.page_id != 1] == [(4, None)]


SUFFIXES = {"a.b.shop.co.uk": "shop.co.uk", "co.uk": None, "uk": None, "x.uk": "x.uk", "a.b.ck": "a.b.ck", "b.ck": None, "y.a.b.ck": "a.b.ck",
            "www.ck": "www.ck", "z.www.ck": "www.ck", "ck": None, "UP.Example.Com.": "example.com", "plain.unlisted": "plain.unlisted",
            "localhost": None, "10.0.0.1": "10.0.0.1", "": None, None: None}


def test_registered_domains(spark):
    rules = spark.createDataFrame([(r,) for r in ("com", "uk", "co.uk", " CO.UK ", "*.ck", "!www.ck", "", None)], "rule string")
    hosts = spark.createDataFrame([(h, 7) for h in list(SUFFIXES) + ["a.b.ck"]], "h string, registered_domain int").drop("registered_domain")
    rows = U.with_registered_domain(hosts, "h", rules).collect()
    assert len(rows) == len(SUFFIXES) + 1 and {r.h: r.registered_domain for r in rows} == SUFFIXES
    none = U.with_registered_domain(hosts, "h", rules.limit(0)).collect()
    assert {r.h: r.registered_domain for r in none}["a.b.shop.co.uk"] == "co.uk"


@pytest.mark.parametrize("operator", [L.referring_domains, L.backlink_overview, L.anchors, L.top_pages])
def test_profiles_take_suffix_rules(spark, operator):
    facts = spark.createDataFrame([("a.x.co.uk", "t", "/", "w", False, False), ("b.y.co.uk", "t", "/", "w", True, False)],
                                  "src_host string, target_host string, target_path string, anchor string, nofollow boolean, has_img boolean")
    rules = spark.createDataFrame([("co.uk",)], "rule string")
    if operator is L.referring_domains:
        assert sorted(r.ref_domain for r in operator(facts, suffixes=rules).collect()) == ["x.co.uk", "y.co.uk"]
        assert [r.ref_domain for r in operator(facts).collect()] == ["co.uk"]
    else:
        assert operator(facts, suffixes=rules).first().referring_domains == 2 and operator(facts).first().referring_domains == 1
