"""Paid-media benchmarks (A-06, A-15, U-02, K-08 ... K-10, J-05, D-03,
C-03, C-05, C-06, X-02, X-03)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import dround, parse_cpc, parse_volume_legacy
from ..session import checkpointed
from .quantiles import upper_median


def top_paid_keywords(paid: DataFrame, n: int = 10, by=("domain",)) -> DataFrame:
    """First n paid keywords of each competitor in page order (K-08).
    ``row_number <= n`` runs as a window group limit (partial top-k)."""
    w = W.partitionBy(*by).orderBy("position")
    return paid.withColumn("kw_rank", F.row_number().over(w)).filter(F.col("kw_rank") <= n)


def keyword_lookups(market: DataFrame, max_keywords: int | None = None, by=()) -> DataFrame:
    """Keyword CPC lookups of the market keywords (K-10), one per client
    (``by``) and keyword, the last lookup of a repeated keyword winning
    (dictionary assignment).  ``max_keywords`` keeps the first keywords of
    each client, as the tool does to spare its source; all for None."""
    if max_keywords is not None:
        n = F.row_number().over(W.partitionBy(*by).orderBy("seq"))
        market = market.withColumn("__n", n).filter(F.col("__n") <= max_keywords)
    return (market.groupBy(*by, "keyword")
            .agg(F.max_by(F.struct("volume_raw", "cpc_raw", "competition_raw"), F.col("seq")).alias("v"))
            .select(*by, "keyword", "v.volume_raw", "v.cpc_raw", "v.competition_raw"))


def cpc_pool(top_paid: DataFrame, lookups: DataFrame, by=()) -> DataFrame:
    """U-02: per client (``by``), the bag of CPC values from competitor keywords and lookups, and the
    lookup volumes (X-02, X-03).

    A CPC that is empty or unparseable is skipped.  A lookup volume is kept
    only when its CPC did not fail: a NULL or unparseable CPC aborts the
    lookup's volume too (both sit in one try), an empty CPC does not.
    """
    comp = top_paid.select(*by, parse_cpc("cpc_raw").alias("cpc"), F.lit(None).cast("double").alias("volume"))
    cpc_str = F.translate(F.coalesce(F.col("cpc_raw"), F.lit("None")), "$,", "")
    cpc_val = parse_cpc(F.coalesce(F.col("cpc_raw"), F.lit("None")))
    cpc_failed = (cpc_str != "") & cpc_val.isNull()
    look = lookups.select(*by, cpc_val.alias("cpc"),
                          F.when(~cpc_failed, parse_volume_legacy(F.coalesce(F.col("volume_raw"), F.lit(""))))
                          .alias("volume"))
    return comp.unionByName(look)


def average_cpc(pool: DataFrame, by=()) -> DataFrame:
    """(by..., avg_cpc): the mean CPC of A-06 alone, for a projection's
    benchmark; one aggregation, without the counts and the median.  A client
    without a known CPC has a null mean."""
    return pool.groupBy(*by).agg(dround(F.avg("cpc"), 6).alias("avg_cpc"))


def industry_averages(pool: DataFrame, n_keywords: DataFrame, n_competitors: DataFrame, by=()) -> DataFrame:
    """A-06: avg/min/max CPC, upper median (``sorted(x)[n // 2]`` ==
    ``percentile_disc(0.5)`` over descending order), average volume and the
    analysed counts; NULL statistics when the pool is empty.  With ``by`` one
    row per client that has a keyword or a competitor, the two counts being
    keyed in the same way; without, each count is a table of one row.  The pool
    is counted by distinct CPC once (partial + final), and everything comes
    from that table; the median by counting passes over value ranges, so that a
    client with a third of all CPCs, all of them different, takes no more
    memory than any other (see :func:`upper_median`)."""
    counts = checkpointed(pool.groupBy(*by, "cpc").agg(
        F.count(F.lit(1)).alias("n"), F.sum("volume").alias("volume"), F.count("volume").alias("volumes")))
    priced = F.when(F.col("cpc").isNotNull(), F.col("n"))
    stats = counts.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("cpc") * F.col("n")), F.sum(priced)).alias("avg_cpc"),
        F.min("cpc").alias("min_cpc"), F.max("cpc").alias("max_cpc"),
        F.try_divide(F.sum("volume"), F.sum("volumes")).alias("avg_volume"))
    median = upper_median(counts, by, "cpc", "n", "median_cpc")
    if by:
        same = [stats[c].eqNullSafe(median[c]) for c in by]
        stats = stats.join(median, same, "left").select(*[stats[c] for c in stats.columns], "median_cpc")
    else:  # one row, or none where no CPC is known
        stats = stats.join(median, F.lit(True), "left")
    rows = stats.select(*by, dround("avg_cpc", 6).alias("avg_cpc"), "min_cpc", "max_cpc", "median_cpc",
                        dround("avg_volume", 6).alias("avg_volume"))
    if not by:  # one row each
        return rows.crossJoin(n_keywords).crossJoin(n_competitors)
    counts = [c for n in (n_keywords, n_competitors) for c in n.columns if c not in by]
    return rows.join(n_keywords, list(by), "full").join(n_competitors, list(by), "full").fillna(0, counts)


def paid_overview(paid: DataFrame, by=("domain",), order=("position",)) -> DataFrame:
    """A-15 (our definition): distinct paid keywords, traffic = sum of clicks,
    cost = sum of clicks x CPC; top keyword = the first in ``order`` (the page
    position or the columns that it is made from) and its raw CPC (K-09)."""
    cpc = parse_cpc("cpc_raw")
    return paid.groupBy(*by).agg(
        F.count_distinct("keyword").alias("n_keywords"),
        F.sum("clicks").alias("traffic"),
        dround(F.sum(F.col("clicks") * F.coalesce(cpc, F.lit(0.0))), 2).alias("traffic_cost"),
        F.min_by(F.struct("keyword", "cpc_raw"), F.struct(*order)).alias("top"))


def advertising_cards(cards: DataFrame) -> DataFrame:
    """C-03 / C-06: raw card strings, blank ones dropped first; the
    advertising metrics only when at least three values are left, the
    shopping-ad count from the first."""
    v = F.filter("values", lambda x: F.coalesce(F.trim(x), F.lit("")) != "")
    ok = F.size(v) >= 3
    return cards.select(
        "domain",
        F.when(ok, F.get(v, 0)).alias("paid_keywords_raw"),
        F.when(ok, F.get(v, 1)).alias("paid_traffic_raw"),
        F.when(ok, F.get(v, 2)).alias("paid_cost_raw"),
        F.get(v, 0).alias("pla_keywords_raw"))


def paid_summary(cards: DataFrame, paid: DataFrame, order=("position",)) -> DataFrame:
    """D-03 / J-05: one row per analysed competitor: raw card metrics, the
    computed overview and the top keyword ('' when it has none)."""
    ov = paid_overview(paid, order=order)
    return advertising_cards(cards).join(ov, "domain", "left").select(
        "domain", "paid_keywords_raw", "paid_traffic_raw", "paid_cost_raw", "pla_keywords_raw",
        F.coalesce("n_keywords", F.lit(0)).alias("n_keywords"),
        F.coalesce("traffic", F.lit(0.0)).alias("traffic"),
        F.coalesce("traffic_cost", F.lit(0.0)).alias("traffic_cost"),
        F.coalesce(F.col("top.keyword"), F.lit("")).alias("top_keyword"),
        F.coalesce(F.col("top.cpc_raw"), F.lit("")).alias("top_cpc"))
