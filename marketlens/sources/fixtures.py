"""Adapter views: the shared TPC-H-ish tables re-shaped into the inputs the
marketing operators expect (reviews, keyword observations, paid keywords,
scenarios, link facts, scraped rows and cards, client settings).

Every view exists twice: as a lazy Spark DataFrame (``*_df``) and as a
DuckDB SQL text (``VIEW_SQL``) that the oracles inline as a CTE.  The views
read whole tables; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import dealt
from .tables import Tables


# --------------------------------------------------------------------------
# reviews_v
# --------------------------------------------------------------------------
def reviews_df(t: Tables, prepare=None) -> DataFrame:
    """review_seq, brand, location, text, rating (NULL where unlabelled).

    ``prepare`` (DataFrame -> DataFrame) runs on the documents side *before*
    the rating join, so per-text scoring happens where the text is read and
    the join/shuffle carries only the derived columns.  The texts are dealt
    over all tasks for it, as few may have read them.
    """
    docs = t.documents.select(F.col("doc_id").alias("review_seq"), F.col("source").alias("brand"),
                              F.col("lang").alias("location"), "text")
    if prepare is not None:
        docs = prepare(dealt(docs))
    labels = t.labels.select(
        F.col("doc_id").alias("review_seq"),
        F.when(F.col("quality") == 0, F.lit(2)).when(F.col("quality") == 1, F.lit(5))
        .cast("int").alias("rating"))
    return docs.join(labels, "review_seq", "left")


REVIEWS_SQL = """
select d.doc_id as review_seq, d.source as brand, d.lang as location, d.text,
       cast(case when l.quality=0 then 2 when l.quality=1 then 5 end as integer) as rating
from documents d left join labels l on d.doc_id=l.doc_id"""


# --------------------------------------------------------------------------
# keyword_obs_v: five ranked keyword sources over `part`
# --------------------------------------------------------------------------
def keyword_obs_df(t: Tables) -> DataFrame:
    # a client per nation; five neighbouring parts, one of each source, go to one client
    n = t.nation.select("n_nationkey", F.col("n_name").alias("client_id"))
    p = t.part.join(F.broadcast(n), F.floor(F.col("p_partkey") / 5) % 25 == F.col("n_nationkey"))
    size = F.col("p_size").cast("string")
    k4 = F.col("p_partkey") % 4
    return p.select(
        "client_id",
        F.col("p_partkey").alias("seq"),
        ((F.col("p_partkey") % 5).cast("int") + 1).alias("source_rank"),
        F.concat(F.col("p_name"), F.lit(" "), F.lower("p_type")).alias("keyword"),
        F.when(k4 == 0, F.concat(size, F.lit("K")))
         .when(k4 == 1, F.concat(size, F.lit(".5K")))
         .when(k4 == 2, size).otherwise(F.lit("n/a")).alias("volume_raw"),
        F.concat(size, F.lit("%")).alias("kd_raw"),
        F.concat(F.lit("$"), F.col("p_retailprice").cast("decimal(10,2)").cast("string")).alias("cpc_raw"),
        F.substring(F.lit("TCIN"), (k4 + 1).cast("int"), F.lit(1)).alias("intent_raw"),
        F.col("p_brand").alias("domain"),
    )


KEYWORD_OBS_SQL = """
select n.n_name as client_id, p_partkey as seq, cast(p_partkey % 5 as integer)+1 as source_rank,
       p_name || ' ' || lower(p_type) as keyword,
       case when p_partkey%4=0 then cast(p_size as varchar) || 'K'
            when p_partkey%4=1 then cast(p_size as varchar) || '.5K'
            when p_partkey%4=2 then cast(p_size as varchar) else 'n/a' end as volume_raw,
       cast(p_size as varchar) || '%' as kd_raw,
       '$' || cast(cast(p_retailprice as decimal(10,2)) as varchar) as cpc_raw,
       substring('TCIN', cast(p_partkey%4 as integer)+1, 1) as intent_raw,
       p_brand as domain
from part join nation n on n.n_nationkey = (p_partkey // 5) % 25"""


# --------------------------------------------------------------------------
# ask_kw_v: the market keywords as people ask them, one phrase after the other
# --------------------------------------------------------------------------
ASK_PHRASES = ["how to choose ", "compare ", "cost of ", "best ", ""]


def ask_keywords_df(t: Tables) -> DataFrame:
    obs = keyword_obs_df(t)
    phrase = F.get(F.array(*[F.lit(x) for x in ASK_PHRASES]), (F.col("seq") % len(ASK_PHRASES)).cast("int"))
    return obs.select("client_id", "seq", F.concat(phrase, "keyword").alias("keyword"))


ASK_KEYWORDS_SQL = f"""
select client_id, seq, {ASK_PHRASES!r}[seq % {len(ASK_PHRASES)} + 1] || keyword as keyword from keyword_obs_v"""


# --------------------------------------------------------------------------
# paid_kw_v: competitor paid keywords (domain = supplier, keyword = part)
# --------------------------------------------------------------------------
#: Columns whose ascending order is that of the page positions.
PAID_ORDER = ("minus_price", "l_orderkey", "l_linenumber", "l_partkey")


def paid_kw_df(t: Tables, positions: bool = True, max_position: int | None = None, order_columns: bool = False,
               domains: DataFrame | None = None) -> DataFrame:
    """Competitor paid keywords (domain = supplier, keyword = part, one row
    per line item).  ``positions=False`` skips the page-position numbering
    for consumers that never read it; ``max_position=k`` keeps only the
    first k positions of every supplier, planned as a window group limit
    (partial top-k before the shuffle, so a hot supplier is never sorted
    whole in one task) over the line's own columns; names and page strings are
    made for the lines that are left."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                           "l_extendedprice", "l_quantity", "l_discount")
    p = t.part.select("p_partkey", "p_name", "p_retailprice")
    s = names = t.supplier.select("s_suppkey", "s_name")
    if domains is not None:  # only these domains' lines are numbered
        s = s.join(domains.select(F.col("domain").alias("s_name")).distinct(), "s_name", "left_semi")
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey")]
    if max_position is not None and positions and not order_columns:
        # the first k lines of a supplier's key hold the first k of its name
        known = (li.join(s, li.l_suppkey == s.s_suppkey, "left_semi").join(p, li.l_partkey == p.p_partkey, "left_semi"))
        of_key = F.row_number().over(W.partitionBy("l_suppkey").orderBy(*order))
        li = known.withColumn("__n", of_key).filter(F.col("__n") <= max_position).drop("__n")
        s = names  # only wanted lines are left
    j = li.join(p, li.l_partkey == p.p_partkey).join(s, li.l_suppkey == s.s_suppkey)
    # page position = rank of the line by price inside its supplier.  A
    # supplier may hold a large share of all lines, so all positions are
    # numbered over range-partitioned pieces, never in one task per supplier.
    from ..operators.ranking import grouped_row_number
    base = j.select(
        F.col("s_name").alias("domain"),
        F.col("p_name").alias("keyword"),
        F.concat(F.lit("$"), (F.floor("p_retailprice") / 100).cast("decimal(12,2)").cast("string"))
         .alias("cpc_raw"),
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("K")).alias("volume_raw"),
        F.concat((F.col("l_discount") * 100).cast("decimal(10,1)").cast("string"), F.lit("%"))
         .alias("traffic_pct_raw"),
        F.col("l_quantity").alias("clicks"),
        "l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey")
    cols = ["domain", "keyword", "cpc_raw", "volume_raw", "traffic_pct_raw", "clicks"]
    if order_columns:
        return base.withColumn("minus_price", -F.col("l_extendedprice")).select(*cols, *PAID_ORDER)
    if not positions:
        return base.select(*cols)
    if max_position is not None:
        top = base.withColumn("position", F.row_number().over(W.partitionBy("domain").orderBy(*order)))
        return top.filter(F.col("position") <= max_position).select(
            "domain", "keyword", "position", *cols[2:])
    ranked = grouped_row_number(base, ["domain"], order)
    return ranked.select("domain", "keyword", "position", *cols[2:])


PAID_KW_SQL = """
select s.s_name as domain, p.p_name as keyword,
       cast(row_number() over (partition by s.s_name
         order by l.l_extendedprice desc, l.l_orderkey, l.l_linenumber, l.l_partkey) as integer) as position,
       '$' || cast(cast(floor(p.p_retailprice)/100 as decimal(12,2)) as varchar) as cpc_raw,
       cast(cast(l.l_quantity as integer) as varchar) || 'K' as volume_raw,
       cast(cast(l.l_discount*100 as decimal(10,1)) as varchar) || '%' as traffic_pct_raw,
       l.l_quantity as clicks
from lineitem l join part p on l.l_partkey=p.p_partkey join supplier s on l.l_suppkey=s.s_suppkey"""


# --------------------------------------------------------------------------
# scenario_v: one projection scenario per customer
# --------------------------------------------------------------------------
def scenario_df(t: Tables) -> DataFrame:
    c = t.customer.select("c_custkey", "c_acctbal", "c_nationkey")
    o = t.orders.select("o_custkey", "o_totalprice")
    aov = o.groupBy("o_custkey").agg(F.avg("o_totalprice").alias("aov"))
    n = t.nation.select("n_nationkey", F.col("n_name").alias("client_id"))
    j = (c.join(aov, c.c_custkey == aov.o_custkey, "left")  # no orders: the default AOV
         .join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")))
    return j.select(
        "client_id",
        F.col("c_custkey").alias("scenario_id"),
        F.when(F.col("c_custkey") % 11 == 0, F.lit("unknown_trade")).otherwise(F.lit("luxury_ecommerce")).alias("industry"),
        F.col("c_acctbal").alias("monthly_ad_spend"),
        F.coalesce("aov", F.lit(100.0)).alias("aov"),
        F.when(F.col("c_custkey") % 19 == 0, F.lit(0.0)).when(F.col("c_custkey") % 3 == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(1.0) + F.col("c_nationkey").cast("double") / 10.0).alias("cpc"),
        F.when(F.col("c_custkey") % 5 == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(1.0) + (F.col("c_custkey") % 7).cast("double") * 0.5).alias("conversion_rate"),
        F.when(F.col("c_custkey") % 13 == 0, F.lit(0)).when(F.col("c_custkey") % 17 != 0,
               F.lit(6) + (F.col("c_custkey") % 3).cast("int") * 4).alias("months"),
    )


SCENARIO_SQL = """
select n.n_name as client_id, c.c_custkey as scenario_id, case when c.c_custkey%11=0 then 'unknown_trade' else 'luxury_ecommerce' end as industry,
       c.c_acctbal as monthly_ad_spend, coalesce(avg(o.o_totalprice), 100.0) as aov,
       case when c.c_custkey%19=0 then 0.0 when c.c_custkey%3=0 then null else 1.0 + cast(c.c_nationkey as double)/10.0 end as cpc,
       case when c.c_custkey%5=0 then null else 1.0 + cast(c.c_custkey%7 as double)*0.5 end as conversion_rate,
       case when c.c_custkey%13=0 then 0 when c.c_custkey%17<>0 then 6 + cast(c.c_custkey%3 as integer)*4 end as months
from customer c join nation n on n.n_nationkey = c.c_nationkey left join orders o on c.c_custkey=o.o_custkey
group by n.n_name, c.c_custkey, c.c_acctbal, c.c_nationkey"""


# --------------------------------------------------------------------------
# links_v: synthetic cross-domain link facts, three per stored page
# --------------------------------------------------------------------------
def links_df(t: Tables) -> DataFrame:
    pages = t.pages.select("page_id", "url")
    k = F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("k")
    x = pages.select("page_id", "url", k)
    pk = F.col("page_id") + F.col("k")
    return x.select(
        (F.col("page_id") * 3 + F.col("k")).alias("link_id"),
        F.regexp_extract("url", r"https?://([^/]+)", 1).alias("src_host"),
        F.col("url").alias("src_url"),
        F.concat(F.lit("site"), ((F.col("page_id") * 7 + F.col("k")) % 13).cast("string"),
                 F.lit(".example")).alias("target_host"),
        F.concat(F.lit("/p"), (pk % 9).cast("string")).alias("target_path"),
        F.concat(F.lit("anchor"), (pk % 11).cast("string")).alias("anchor"),
        F.when(pk % 4 == 0, F.lit("nofollow")).alias("rel"),
        (pk % 5 == 0).alias("has_img"),
    )


LINKS_SQL = """
select page_id*3+k as link_id, regexp_extract(url,'https?://([^/]+)',1) as src_host, url as src_url,
       'site' || cast((page_id*7+k) % 13 as varchar) || '.example' as target_host,
       '/p' || cast((page_id+k) % 9 as varchar) as target_path,
       'anchor' || cast((page_id+k) % 11 as varchar) as anchor,
       case when (page_id+k)%4=0 then 'nofollow' end as rel, ((page_id+k)%5=0) as has_img
from pages cross join (select 1 as k union all select 2 union all select 3) x"""


# --------------------------------------------------------------------------
# linked_pages_v: stored pages with every kind of link: external, nofollow, image,
# mailto, without target, unclosed, encoded, relative to the page or to a base
# --------------------------------------------------------------------------
# What a page says, in order; {n} is the page's number.
LINKED_HTML = (
    '<p><A HREF="https://Partner{n}.co.uk:8080/deals/../offers/./x?id={n}#top" rel="sponsored NoFollow">Offer {n}</A>',
    "<a class=\"x>y\" href='/shop/../about'>About <b>us</b></a>",
    '<a href="mailto:a{n}@example.com">Mail</a><a name="here">no target</a>',
    '<a href=//cdn{n}.example.ck/i.png><IMG src="i.png"> </a>',
    '<a href="sub/page{n}.html?a=1&amp;b=&#50;&#x33;">unclosed <a href="?q={n}">Query</a>',
    '<a href="../../up">Up</a> <a href="">Self</a> <a href="#frag">Frag</a> <a href="javascript:void(0)">Run</a>',
    '<a href="https://user@www.ck/a//b/">Odd</a> <a href="https://blog{n}.shop.co.uk">Plain</a></p>',
)
LINKED_BASES = ("", '<base href="/docs/guide/">', '<BASE target=_top href="https://mirror.example.org/m/{n}/">', "", "")


def _numbered(texts) -> list[tuple[str, bool]]:
    """The parts of the texts, and whether the page's number follows."""
    split = [text.split("{n}") for text in texts]
    return [(part, k + 1 < len(parts)) for parts in split for k, part in enumerate(parts)]


def linked_pages_df(t: Tables) -> DataFrame:
    n = F.col("page_id").cast("string")

    def said(*texts):
        out = []
        for part, numbered in _numbered(texts):
            out += [F.lit(part)] + ([n] if numbered else [])
        return F.concat(*out)

    base = F.lit("")
    for k, text in enumerate(LINKED_BASES):
        base = F.when(F.col("page_id") % len(LINKED_BASES) == k, said(text)).otherwise(base)
    return t.pages.select("page_id", F.concat(F.lit("https://www.site"), (F.col("page_id") % 7).cast("string"), F.lit(".example.com/a/b/p"), n,
                                              F.lit("?old=1")).alias("url"),
                          F.concat(F.lit("<html><head>"), base, F.lit("</head><body>"), said(*LINKED_HTML), F.col("html")).alias("html"))


def _linked_sql() -> str:
    def said(*texts):
        out = []
        for part, numbered in _numbered(texts):
            out += ["'" + part.replace("'", "''") + "'"] + (["page_id"] if numbered else [])
        return " || ".join(out)

    bases = " ".join(f"when page_id % {len(LINKED_BASES)} = {k} then {said(text)}" for k, text in enumerate(LINKED_BASES))
    return f"""
select page_id, 'https://www.site' || (page_id % 7) || '.example.com/a/b/p' || page_id || '?old=1' as url,
       '<html><head>' || case {bases} end || '</head><body>' || {said(*LINKED_HTML)} || html as html
from pages"""


LINKED_PAGES_SQL = _linked_sql()


# --------------------------------------------------------------------------
# suffix_links_v: links_v from hosts under all kinds of public suffixes, and the
# rules for them
# --------------------------------------------------------------------------
# Hosts by turns, {n} being a number; and rules of a suffix list.
SUFFIX_HOSTS = ("a{n}.shop.co.uk", "www.shop.co.uk", "co.uk", "b{n}.c.ck", "c.ck", "x{n}.www.ck", "www.ck", "{n}.kobe.jp", "z.y{n}.kobe.jp",
                "www.city.kobe.jp", "user{n}.github.io", "github.io", "10.0.0.{n}", "localhost", "Deep.A.B.Example.COM", "unlisted.tld{n}", "example.com.")
SUFFIX_RULES = ("com", "uk", "co.uk", "*.ck", "!www.ck", "jp", "*.kobe.jp", "!city.kobe.jp", "io", "github.io")


def suffix_links_df(t: Tables) -> DataFrame:
    n = (F.col("link_id") % 23).cast("string")
    hosts = F.array(*[F.concat(*[x for k, part in enumerate(h.split("{n}")) for x in ([n] if k else []) + [F.lit(part)]]) for h in SUFFIX_HOSTS])
    return links_df(t).withColumn("src_host", F.get(hosts, (F.col("link_id") % len(SUFFIX_HOSTS)).cast("int")))


def suffix_rules_df(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([(r,) for r in SUFFIX_RULES], "rule string")


SUFFIX_LINKS_SQL = f"""
select * replace (replace({list(SUFFIX_HOSTS)!r}[link_id % {len(SUFFIX_HOSTS)} + 1], '{{n}}', cast(link_id % 23 as varchar)) as src_host) from links_v"""
SUFFIX_RULES_SQL = f"select unnest({list(SUFFIX_RULES)!r}) as rule"


# --------------------------------------------------------------------------
# clients_v: one client per nation; its suppliers in key order are the
# target (seq 0) and competitors (seq 1..); first five are 'primary'.
# --------------------------------------------------------------------------
def clients_df(t: Tables) -> DataFrame:
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    # nation is a fixed 25-row dimension: broadcast is size-bounded.
    j = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
    w = W.partitionBy("n_name").orderBy("s_suppkey")
    seq = F.row_number().over(w) - 1
    return j.select(
        F.col("n_name").alias("client_id"),
        seq.cast("int").alias("seq"),
        F.col("s_name").alias("domain"),
        F.when(F.col("s_suppkey") % 7 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Brand "), F.col("s_suppkey").cast("string"))).alias("name"),
        F.when(seq <= 5, F.lit("primary")).otherwise(F.lit("secondary")).alias("priority"),
    )


CLIENTS_SQL = """
select n.n_name as client_id,
       cast(row_number() over (partition by n.n_name order by s.s_suppkey) - 1 as integer) as seq,
       s.s_name as domain,
       case when s.s_suppkey%7=0 then null else 'Brand ' || cast(s.s_suppkey as varchar) end as name,
       case when row_number() over (partition by n.n_name order by s.s_suppkey) - 1 <= 5
            then 'primary' else 'secondary' end as priority
from supplier s join nation n on s.s_nationkey=n.n_nationkey"""


# --------------------------------------------------------------------------
# ranked_kw_v: the keywords that domains rank for, with similarities from 0 to 1.
# A shop per nation and market segment ranks for what its customers ordered; its
# mirrors hold all of that, nine tenths, half and a tenth; every site ranks for
# one common keyword, and each nation has a site that shares no other one.
# --------------------------------------------------------------------------
def ranked_kw_df(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    li = t.lineitem.select("l_orderkey", "l_partkey")
    sold = (li.join(o.join(c, o.o_custkey == c.c_custkey), li.l_orderkey == F.col("o_orderkey"))
            .select(F.col("c_nationkey").alias("nation"), F.lower("c_mktsegment").alias("segment"), F.col("l_partkey").alias("part")).distinct())
    kinds = F.array(F.lit("shop"), F.lit("copy"), F.when(F.col("part") % 10 != 0, F.lit("mirror")),
                    F.when(F.col("part") % 2 == 0, F.lit("outlet")), F.when(F.col("part") % 10 == 3, F.lit("blog")))
    rows = sold.select("nation", "segment", "part", F.explode(F.filter(kinds, lambda x: x.isNotNull())).alias("kind"))
    rows = rows.select(F.concat_ws("-", "kind", "segment", "nation").alias("domain"),
                       F.concat(F.lit("keyword "), F.col("part").cast("string")).alias("keyword"))
    alone = t.nation.select(F.concat(F.lit("alone-"), F.col("n_nationkey").cast("string")).alias("domain"),
                            F.concat(F.lit("only "), "n_name").alias("keyword"))
    every = rows.unionByName(alone)
    return every.unionByName(every.select("domain").distinct().filter(~F.col("domain").startswith("alone-7"))
                             .withColumn("keyword", F.lit("buy online")))


def ranked_targets_df(t: Tables) -> DataFrame:
    """(client_id, target): the building shop of each nation, and its lone site."""
    kinds = F.explode(F.array(F.lit("shop-building-"), F.lit("alone-"))).alias("kind")
    return t.nation.select(F.col("n_name").alias("client_id"), "n_nationkey", kinds).select(
        "client_id", F.concat("kind", F.col("n_nationkey").cast("string")).alias("target"))


RANKED_KW_SQL = """
with sold as (
  select distinct c_nationkey as nation, lower(c_mktsegment) as segment, l_partkey as part
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey),
every as (
  select 'shop-' || segment || '-' || nation as domain, 'keyword ' || part as keyword from sold
  union all select 'copy-' || segment || '-' || nation, 'keyword ' || part from sold
  union all select 'mirror-' || segment || '-' || nation, 'keyword ' || part from sold where part % 10 <> 0
  union all select 'outlet-' || segment || '-' || nation, 'keyword ' || part from sold where part % 2 = 0
  union all select 'blog-' || segment || '-' || nation, 'keyword ' || part from sold where part % 10 = 3
  union all select 'alone-' || n_nationkey, 'only ' || n_name from nation)
select domain, keyword from every
union all select distinct domain, 'buy online' from every where not starts_with(domain, 'alone-7')"""

RANKED_TARGETS_SQL = """
select n_name as client_id, kind || n_nationkey as target
from nation cross join (select unnest(['shop-building-', 'alone-']) as kind)"""


# --------------------------------------------------------------------------
# brands_v: the brands that a client follows: those of its suppliers, and the
# first word of four letters of each user turn (the names that users bring up)
# --------------------------------------------------------------------------
def brands_df(t: Tables) -> DataFrame:
    named = clients_df(t).select("client_id", F.coalesce("name", "domain").alias("brand"))
    n = t.nation.select("n_nationkey", F.col("n_name").alias("client_id"))
    asked = (t.conversations.filter(F.col("role") == "user")
             .select((F.col("conv_id") % 25).cast("long").alias("n_nationkey"),
                     F.regexp_extract("text", "[A-Za-z]{4,}", 0).alias("brand"))
             .filter(F.length("brand") > 0).join(F.broadcast(n), "n_nationkey").select("client_id", "brand"))
    return named.unionByName(asked).distinct()


BRANDS_SQL = """
select client_id, coalesce(name, domain) as brand from clients_v
union
select n.n_name, regexp_extract(c.text, '[A-Za-z]{4,}', 0) from conversations c join nation n on n.n_nationkey = c.conv_id % 25
where c.role = 'user' and regexp_extract(c.text, '[A-Za-z]{4,}', 0) <> ''"""


# --------------------------------------------------------------------------
# raw_rows_v / raw_cards_v: scraped table rows and metric cards
# --------------------------------------------------------------------------
def raw_rows_df(t: Tables) -> DataFrame:
    p = t.part
    size = F.col("p_size").cast("string")
    price = F.col("p_retailprice").cast("decimal(10,2)").cast("string")
    code = F.substring(F.lit("TCINX"), (F.col("p_partkey") % 5 + 1).cast("int"), F.lit(1))
    cells = F.array(
        size,
        F.concat(F.col("p_name"), F.lit("\nmore")),
        F.concat(code, F.lit("\n$"), price),
        F.concat(size, F.lit("K")),
        F.concat(F.lit("https://"), F.lower(F.replace(F.col("p_brand"), F.lit("#"), F.lit(""))),
                 F.lit(".example/"), F.col("p_partkey").cast("string")),
    )
    return p.select(
        F.col("p_brand").alias("domain"),
        F.col("p_partkey").alias("row_seq"),
        F.when(F.col("p_partkey") % 10 == 9, F.slice(cells, 1, 2)).otherwise(cells).alias("cells"),
    )


RAW_ROWS_SQL = """
select p_brand as domain, p_partkey as row_seq,
       case when p_partkey%10=9 then cells[1:2] else cells end as cells
from (select p_brand, p_partkey, list_value(
        cast(p_size as varchar),
        p_name || chr(10) || 'more',
        substring('TCINX', cast(p_partkey%5 as integer)+1, 1) || chr(10) || '$'
            || cast(cast(p_retailprice as decimal(10,2)) as varchar),
        cast(p_size as varchar) || 'K',
        'https://' || lower(replace(p_brand, '#', '')) || '.example/' || cast(p_partkey as varchar)) as cells
      from part)"""


def raw_cards_df(t: Tables) -> DataFrame:
    s = t.supplier
    bal = F.abs(F.col("s_acctbal"))
    vals = F.array(
        (F.col("s_suppkey") % 101).cast("string"),
        F.concat((F.floor(bal / 100) / 10).cast("decimal(10,1)").cast("string"), F.lit("K")),
        F.concat(F.lit("$"), (F.floor(bal) / 100).cast("decimal(10,2)").cast("string")),
        F.col("s_nationkey").cast("string"),
        F.concat(F.col("s_suppkey").cast("string"), F.lit(",000")),
    )
    n = (F.col("s_suppkey") % 6).cast("int")
    return s.select(F.col("s_name").alias("domain"),
                    F.when(n == 0, F.array().cast("array<string>"))
                    .when(n < 5, F.slice(vals, 1, n)).otherwise(vals).alias("values"))


RAW_CARDS_SQL = """
select domain, case when n=0 then []::varchar[] when n<5 then vals[1:n] else vals end as "values"
from (select s_name as domain, cast(s_suppkey%6 as integer) as n, list_value(
        cast(s_suppkey%101 as varchar),
        cast(cast(floor(abs(s_acctbal)/100)/10 as decimal(10,1)) as varchar) || 'K',
        '$' || cast(cast(floor(abs(s_acctbal))/100 as decimal(10,2)) as varchar),
        cast(s_nationkey as varchar),
        cast(s_suppkey as varchar) || ',000') as vals
      from supplier)"""


# --------------------------------------------------------------------------
# raw_pages_v: pages of every type with their elements; ref_rows_v: rows of
# referring domains.  An element's text is a SQL expression of both engines over a
# supplier's key, name and card values v1 ... v5; null means no such element.
# --------------------------------------------------------------------------
# Fixed values: (kind, name, text) in page order.
_CARD_TEXTS = ("v1", "'  '", "v2", "v3 || '  '", "v4", "v5")
PAGE_ELEMENTS = {
    "keyword_overview": [
        ("field", "volume", "case when s_suppkey % 3 = 0 then v2 when s_suppkey % 7 = 1 then '' end"),
        ("field", "volume", "'999'"),
        ("field", "keyword-overview-volume", "case when s_suppkey % 6 = 0 then '0' end"),
        ("field", "keyword-difficulty", "case when s_suppkey % 8 = 4 then '130' end"),
        ("field", "kd", "case when s_suppkey % 4 = 0 then '45%' end"),
        ("field", "cpc", "case when s_suppkey % 5 = 0 then '$1.25' end"),
        ("field", "keyword-overview-cpc", "case when s_suppkey % 10 = 0 then ' ' when s_suppkey % 9 = 0 then '$0.75' end"),
        ("gauge", "", "case when s_suppkey % 2 = 0 then '130' end"),
        ("gauge", "", "cast(s_suppkey % 100 as string) || '%'"),
        ("intent", "", "case s_suppkey % 7 when 0 then 'xyz' when 1 then ' T ' when 2 then 'Commercial' when 3 then 'Informational' when 4 then 'one' end"),
        ("intent", "", "case s_suppkey % 7 when 0 then 'navigational' when 2 then 'zzz' when 4 then 'C' when 5 then 'N' end"),
    ] + [("card", "", x) for x in _CARD_TEXTS],
    "keyword_lookup": [
        ("card", "keyword-overview", "case when s_suppkey % 3 = 0 then v2 when s_suppkey % 3 = 1 then '' end"),
        ("card", "report-card", "v1"), ("card", "report-card", "case when s_suppkey % 3 = 1 then ' ' || v3 end"),
        ("card", "metric", "v4"), ("card", "metric", "''"), ("card", "metric", "v5"), ("card", "report-card", "v5")],
    "backlink_overview": [
        ("field", "authority-score", "case when s_suppkey % 2 = 0 then cast(s_suppkey % 101 as string) end"),
        ("field", "backlinks", "case when s_suppkey % 3 = 0 then '0' when s_suppkey % 3 = 1 then '12,345' end"),
        ("field", "referring-domains", "case when s_suppkey % 5 = 0 then '1.2K' end"),
    ] + [("card", "", x) for x in reversed(_CARD_TEXTS)],
    "ai_overview": [
        ("platform", "", "case when s_suppkey % 2 = 0 then 'ChatGPT' end"), ("platform", "", "' X '"),
        ("platform", "", "case when s_suppkey % 3 = 0 then ' Gemini ' end"), ("platform", "", "case when s_suppkey % 5 = 0 then '' end"),
    ] + [("card", "", x) for x in _CARD_TEXTS],
    "brand_performance": [("card", "", x) for x in _CARD_TEXTS * 3],
    "growth_actions": [
        ("action", "", "'Add FAQ pages for ' || s_name"), ("action", "", "'Fix'"), ("action", "", "case when s_suppkey % 2 = 0 then ' 12345 ' end"),
        ("action", "", "case when s_suppkey % 3 = 0 then '123456' end"), ("card", "", "v1")],
}
REF_ROW_ELEMENTS = [
    ("authority", "", "case when s_suppkey % 2 = 0 then '0' end"), ("authority", "", "cast(s_suppkey % 150 as string)"), ("authority", "", "'7'"),
    ("backlinks", "", "case when s_suppkey % 3 = 0 then 'n/a' end"), ("backlinks", "", "v5")]


def _values_of(t: Tables) -> DataFrame:
    s = t.supplier.join(raw_cards_df(t), F.col("s_name") == F.col("domain")).join(
        F.broadcast(t.nation.select("n_nationkey", F.col("n_name").alias("client_id"))), F.col("s_nationkey") == F.col("n_nationkey"))
    return s.select("client_id", "s_suppkey", "s_name", *[F.get("values", k).alias(f"v{k + 1}") for k in range(5)])


def _variant(elements) -> F.Column:
    each = ", ".join(f"named_struct('kind', '{kind}', 'name', '{name}', 'text', {text}, 'parent', '')" for kind, name, text in elements)
    return F.parse_json(F.to_json(F.expr(f"filter(array({each}), x -> x.text is not null)")))


def raw_pages_df(t: Tables) -> DataFrame:
    base = _values_of(t)
    parts = [base.select("client_id", F.lit(kind).alias("page_type"), F.col("s_name").alias("subject"), _variant(elements).alias("elements"))
             for kind, elements in PAGE_ELEMENTS.items()]
    # a page that was not read as it should be
    parts.append(base.filter("s_suppkey % 50 = 1").select("client_id", F.lit("ai_overview").alias("page_type"),
                                                         F.concat("s_name", F.lit(" (error)")).alias("subject"),
                                                         F.parse_json(F.lit('{"error": 403}')).alias("elements")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def ref_rows_df(t: Tables) -> DataFrame:
    cells = F.expr("""array(case when s_suppkey % 4 = 0 then '12' else '1\nline' end, case when s_suppkey % 5 > 0 then
        'ref' || cast(s_suppkey as string) || '.example\nnew' else 'a.b' end, 'x.y.z')""")
    cells = F.when(F.col("s_suppkey") % 11 == 0, F.slice(cells, 1, 1)).when(F.col("s_suppkey") % 13 == 0, F.slice(cells, 1, 2)).otherwise(cells)
    return _values_of(t).select("client_id", F.col("s_name").alias("subject"), F.col("s_suppkey").alias("row_seq"), cells.alias("cells"),
                                _variant(REF_ROW_ELEMENTS).alias("elements"))


def _elements_sql(elements) -> str:
    each = ", ".join(f"{{'kind': '{kind}', 'name': '{name}', 'text': {text}}}" for kind, name, text in elements)
    return f"list_filter([{each}], lambda x: x.text is not null)"


_VALUES_SQL = """(select n.n_name as client_id, s_suppkey, s_name, "values"[1] as v1, "values"[2] as v2, "values"[3] as v3, "values"[4] as v4,
       "values"[5] as v5 from supplier join raw_cards_v on s_name = domain join nation n on s_nationkey = n.n_nationkey)"""
RAW_PAGES_SQL = "\nunion all\n".join(
    [f"select client_id, '{kind}' as page_type, s_name as subject, {_elements_sql(elements)} as elements from {_VALUES_SQL}"
     for kind, elements in PAGE_ELEMENTS.items()]
    + [f"select client_id, 'ai_overview', s_name || ' (error)', [] from {_VALUES_SQL} where s_suppkey % 50 = 1"])
REF_ROWS_SQL = f"""
select client_id, s_name as subject, s_suppkey as row_seq,
       case when s_suppkey % 11 = 0 then c[1:1] when s_suppkey % 13 = 0 then c[1:2] else c end as cells, {_elements_sql(REF_ROW_ELEMENTS)} as elements
from (select *, [case when s_suppkey % 4 = 0 then '12' else '1' || chr(10) || 'line' end,
                 case when s_suppkey % 5 > 0 then 'ref' || cast(s_suppkey as varchar) || '.example' || chr(10) || 'new' else 'a.b' end, 'x.y.z'] as c
      from {_VALUES_SQL})"""


VIEW_SQL = {
    "reviews_v": REVIEWS_SQL,
    "keyword_obs_v": KEYWORD_OBS_SQL,
    "ask_kw_v": ASK_KEYWORDS_SQL,
    "paid_kw_v": PAID_KW_SQL,
    "scenario_v": SCENARIO_SQL,
    "links_v": LINKS_SQL,
    "linked_pages_v": LINKED_PAGES_SQL,
    "suffix_links_v": SUFFIX_LINKS_SQL,
    "suffix_rules_v": SUFFIX_RULES_SQL,
    "clients_v": CLIENTS_SQL,
    "brands_v": BRANDS_SQL,
    "ranked_kw_v": RANKED_KW_SQL,
    "ranked_targets_v": RANKED_TARGETS_SQL,
    "raw_rows_v": RAW_ROWS_SQL,
    "raw_cards_v": RAW_CARDS_SQL,
    "raw_pages_v": RAW_PAGES_SQL,
    "ref_rows_v": REF_ROWS_SQL,
}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the named views as CTEs (DuckDB oracle text)."""
    ctes = ",\n".join(f"{n} as ({VIEW_SQL[n]})" for n in names)
    return f"with {ctes}\n{sql}" if names else sql


def views_then(body: str, *names: str) -> str:
    """``with <views>, <body>``: ``body`` continues the CTE list (its own
    ``name as (...)`` entries) and ends with the final SELECT."""
    ctes = ",\n".join(f"{n} as ({VIEW_SQL[n]})" for n in names)
    return f"with {ctes},\n{body}"
