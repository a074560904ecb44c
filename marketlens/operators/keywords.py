"""Keyword intelligence: typing, ranked first-source merge, caps, coverage,
ranking, gap, related keywords, organic competitors, top organic keywords
(X-01, X-04, X-06, X-07, K-03 ... K-05, K-13, J-06, J-08, J-10, J-11, A-07).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import dround, intent_label, score_gate, with_parsed_numbers
from ..session import checkpointed
from .joins import pattern_hits
from .similarity import top_k_similar

METRICS = ("volume", "kd", "cpc", "intent")


def parse_metrics(obs: DataFrame) -> DataFrame:
    """Raw keyword observations -> typed metrics (X-01, X-04, X-06, X-07).

    keyword lower-cased (merge key); volume kept only when > 0; KD only in
    (0, 100]; CPC parsed; intent code/label -> label or 'Unknown'.
    """
    extra = [c for c in obs.columns if c not in
             ("keyword", "volume_raw", "kd_raw", "cpc_raw", "intent_raw")]
    parsed = with_parsed_numbers(obs, {"__vol": "volume_raw", "__kd": "kd_raw", "__cpc": "cpc_raw"})
    return parsed.select(
        *extra,
        F.lower("keyword").alias("keyword"),
        score_gate("__vol", None).alias("volume"),
        score_gate("__kd", 100.0).alias("kd"),
        F.col("__cpc").alias("cpc"),
        intent_label("intent_raw").alias("intent"),
    )


def cap_sources(obs: DataFrame, caps: dict, by=()) -> DataFrame:
    """Per-source caps (K-04): ``caps = {source_rank: (max_groups, max_rows[, max_total])}``.

    Within a capped source only the first ``max_groups`` groups (seeds or
    competitor domains, in order of first appearance) are read, and at most
    ``max_rows`` rows per group (page order = ``seq``); ``max_total`` limits
    the rows of the whole source, for a source that is one page, like the gap
    page.  None is no limit; uncapped sources pass through.  All limits are the
    source tool's page/list sizes, counted per client (``by``).
    """
    group_first = obs.groupBy(*by, "source_rank", "domain").agg(F.min("seq").alias("g_first"))
    g_rank = group_first.withColumn(
        "g_rank", F.row_number().over(W.partitionBy(*by, "source_rank").orderBy("g_first", "domain")))
    j = obs.join(g_rank.select(*by, "source_rank", "domain", "g_rank"), [*by, "source_rank", "domain"])
    j = j.withColumn("r_rank", F.row_number().over(W.partitionBy(*by, "source_rank", "domain").orderBy("seq")))
    paged = {src: cap[2] for src, cap in caps.items() if len(cap) > 2 and cap[2] is not None}
    if paged:
        # numbered over the sources that have such a limit; a hot one ships its first rows alone
        one_page = F.col("source_rank").isin(*paged)
        first = F.row_number().over(W.partitionBy(*by, "source_rank").orderBy("seq"))
        most = max(paged.values())
        page = j.filter(one_page).withColumn("t_rank", first).filter(F.col("t_rank") <= most)
        within = F.lit(False)
        for src, total in paged.items():
            within = within | ((F.col("source_rank") == src) & (F.col("t_rank") <= total))
        j = j.filter(~one_page | F.col("source_rank").isNull()).unionByName(page.filter(within).drop("t_rank"))
    keep = F.lit(False)
    capped = []
    for src, (max_groups, max_rows, *_) in caps.items():
        cond = F.col("source_rank") == src
        if max_groups is not None:
            cond = cond & (F.col("g_rank") <= max_groups)
        if max_rows is not None:
            cond = cond & (F.col("r_rank") <= max_rows)
        keep = keep | cond
        capped.append(src)
    keep = keep | ~F.col("source_rank").isin(*capped)
    return j.filter(keep).drop("g_rank", "r_rank")


def merge_keywords(typed: DataFrame, market_rank: int = 1, by=()) -> DataFrame:
    """First-source-wins merge keyed by client (``by``) and lower(keyword)
    (K-03, J-06).

    The lowest ``source_rank`` wins; inside the market source
    (``market_rank``) the *last* duplicate wins (unconditional assignment),
    inside every later source the first one wins (insert-if-absent).  The
    dictionary position of a key is its first insertion: min(source_rank,
    seq).  Implemented as one hash aggregation with ``min_by`` so it
    combines map-side (a hot keyword never lands whole in one task), instead
    of a window sort.
    """
    win_key = F.struct(F.col("source_rank"),
                       F.when(F.col("source_rank") == market_rank, -F.col("seq")).otherwise(F.col("seq")))
    payload = F.struct(*[F.col(c) for c in METRICS], F.col("source_rank"), F.col("seq"))
    agg = typed.groupBy(*by, "keyword").agg(
        F.min_by(payload, win_key).alias("w"),
        F.min(F.struct("source_rank", "seq")).alias("first"))
    return agg.select(*by, "keyword", *[F.col(f"w.{c}").alias(c) for c in METRICS],
                      F.col("w.source_rank").alias("source_rank"), F.col("w.seq").alias("seq"),
                      F.col("first.source_rank").alias("first_rank"), F.col("first.seq").alias("first_seq"))


def keyword_coverage(merged: DataFrame, by=()) -> DataFrame:
    """A-07: total keywords and how many carry volume, KD, CPC, intent."""
    return merged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_keywords"),
        F.count_if(F.col("volume") > 0).alias("with_volume"),
        F.count_if(F.col("kd") > 0).alias("with_kd"),
        F.count_if(F.col("cpc") > 0).alias("with_cpc"),
        F.count_if(F.col("intent") != "Unknown").alias("with_intent"))


def first_competitors(roles: DataFrame, by=("client_id",), k: int | None = None) -> DataFrame:
    """The target (seq 0) and the first ``k`` competitors of each client in
    settings order (all for None), planned as a window group limit."""
    if k is None:
        return roles
    rank = F.row_number().over(W.partitionBy(*by).orderBy("seq", "domain"))
    rivals = roles.filter(F.col("seq") > 0).withColumn("__rank", rank).filter(F.col("__rank") <= k).drop("__rank")
    return roles.filter(F.col("seq") == 0).unionByName(rivals)


def domain_keyword_gap(domain_kw: DataFrame, roles: DataFrame, by=("client_id",),
                       max_competitors: int | None = None) -> DataFrame:
    """Keyword gap of a target against its first competitors (J-08).

    ``roles``: (by..., seq, domain) with seq 0 = target, else competitors (the
    first ``max_competitors`` given take part, whatever their seq, all for
    None: the tool filters first and then takes four).
    Universe = distinct keywords of these domains; ``missing`` = held by >= 1
    competitor and not the target, ``shared`` = target and >= 1 competitor,
    ``unique`` = target only (the three sets partition the universe).
    Carries the competitor count and best competitor position.
    One join on domain (roles are small per client; AQE broadcasts them when
    their measured size allows) and one grouped aggregation, no pairs.
    """
    r = first_competitors(roles, by, max_competitors).select(*by, "seq", "domain")
    j = domain_kw.select("domain", "keyword", "position").join(r, "domain")
    is_t = F.col("seq") == 0
    agg = j.groupBy(*by, "keyword").agg(
        F.max(is_t).alias("in_target"),
        F.count_distinct(F.when(~is_t, F.col("domain"))).alias("n_competitors"),
        F.min(F.when(~is_t, F.col("position"))).alias("best_position"),
        F.min(F.when(is_t, F.col("position"))).alias("target_position"))
    status = (F.when(F.col("in_target") & (F.col("n_competitors") > 0), F.lit("shared"))
              .when(F.col("in_target"), F.lit("unique")).otherwise(F.lit("missing")))
    return agg.select(*by, "keyword", status.alias("status"), "n_competitors", "best_position",
                      "target_position")


def related_keywords(seeds: DataFrame, universe: DataFrame, per_seed: int = 20, by=()) -> DataFrame:
    """Related-keyword discovery (J-10): for every seed, keywords of its own
    client (``by``) that contain the lower-cased seed and differ from it, top
    ``per_seed`` by volume descending then keyword.  Keywords meet seeds by
    the seeds' rarest grams (see :func:`pattern_hits`), at any number of seeds.
    """
    s = seeds.select(*by, "seed_seq", F.lower("seed").alias("seed"))
    hits = pattern_hits(universe.select(*by, "keyword", "volume"), s, "keyword", "seed")
    j = hits.filter(F.col("keyword") != F.col("seed")).join(s, [*by, "seed"])
    w = W.partitionBy(*by, "seed_seq").orderBy(F.desc("volume"), "keyword")
    return (j.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= per_seed)
            .select(*by, "seed_seq", "seed", "rank", "keyword", "volume"))


def organic_competitors(domain_kw: DataFrame, targets: DataFrame, by=("client_id",)) -> DataFrame:
    """Organic competitors of each target domain (J-11).

    shared = |A n B| distinct keywords, score = shared / |A u B|; ranked by
    shared desc, domain asc; the target itself excluded.  Target-centric:
    the join multiplies target keywords by the domains holding them, never
    domain pairs in general.
    """
    # the distinct (domain, keyword) set feeds three consumers: materialise
    # it once (reliable checkpoint) instead of recomputing its input thrice
    dk = checkpointed(domain_kw.select("domain", "keyword").distinct())
    sizes = dk.groupBy("domain").agg(F.count(F.lit(1)).alias("n_kw"))
    t = targets.select(*by, F.col("domain").alias("target"))
    tk = dk.join(t, dk.domain == t.target).select(*by, "target", "keyword")
    pairs = (tk.join(dk, "keyword").filter(F.col("domain") != F.col("target"))
             .groupBy(*by, "target", "domain").agg(F.count(F.lit(1)).alias("shared")))
    a = sizes.select(F.col("domain").alias("target"), F.col("n_kw").alias("n_target"))
    out = pairs.join(a, "target").join(sizes, "domain")
    score = F.col("shared").cast("double") / (F.col("n_target") + F.col("n_kw") - F.col("shared")).cast("double")
    w = W.partitionBy(*by).orderBy(F.desc("shared"), "domain")
    return out.select(*by, "target", "domain", "shared", dround(score, 6).alias("score"),
                      F.row_number().over(w).alias("rank"))


def top_organic_competitors(domain_kw: DataFrame, targets: DataFrame, k: int = 10, by=("client_id",)) -> DataFrame:
    """The ``k`` organic competitors most similar to each target (J-11): Jaccard
    similarity of the keyword sets descending, then domain.  ``targets``: (by...,
    target); a domain that several clients target is searched for once.  Exact,
    without the pairs that can't be among the first (see :func:`top_k_similar`)."""
    best = top_k_similar(domain_kw.select(F.col("domain").alias("set_id"), F.col("keyword").alias("item")), targets.select("target"), k)
    best = best.select("target", F.col("set_id").alias("domain"), "shared", dround("score", 6).alias("score"), "rank")
    return targets.select(*by, "target").join(best, "target").select(*by, "target", "domain", "shared", "score", "rank")


def top_keywords_by_traffic(facts: DataFrame, k: int = 10, by=("domain",)) -> DataFrame:
    """Top-k keywords per domain by traffic = sum of quantity (K-13).

    Aggregate first (map-side combine), then ``row_number <= k``, which
    Spark runs as a window group limit (partial top-k before the shuffle)."""
    agg = facts.groupBy(*by, "keyword").agg(F.sum("qty").alias("traffic"))
    w = W.partitionBy(*by).orderBy(F.desc("traffic"), "keyword")
    return agg.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
