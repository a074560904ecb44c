"""AI-visibility analytics: trigger classification and counts, prompts,
recommendations, brand mentions (I-01 ... I-03, J-04, A-09, A-10, A-16)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import dround
from ..functions.text import TRIGGER_LIKELIHOOD, trigger_category, with_lowered
from .joins import pattern_hits

# --------------------------------------------------------------------------
# Prompt templates of the source tool, per category in its
# dictionary order.  ``{target}`` is the target name, ``{keyword}`` a market
# keyword, ``{name}`` a competitor name; ``limit`` = how many keywords /
# competitors feed the category.
# --------------------------------------------------------------------------
PROMPT_TEMPLATES = [
    # (category, cat_order, feeds, limit, templates)
    ("brand_direct", 1, "target", None, ["What is {target}?", "Tell me about {target}",
                                         "Is {target} reliable?", "{target} reviews"]),
    ("category_discovery", 2, "keyword", 5, ["What are the best {keyword} companies?", "Who offers {keyword}?"]),
    ("comparison", 3, "competitor", 3, ["{target} vs {name}", "Is {name} or {target} better?"]),
    ("recommendation", 4, "keyword", 3, ["Recommend a good {keyword} service",
                                         "Which {keyword} company should I use?"]),
    ("how_to", 5, "keyword", 5, ["How does {keyword} work?"]),
    ("cost", 6, "keyword", 5, ["How much does {keyword} cost?"]),
]

# The tool's six recommendations.  ``{n}`` is the number of
# keywords in the trigger category named in ``category``.
RECOMMENDATIONS = [
    ("high", "Create FAQ content targeting informational queries",
     "{n} keywords likely trigger AI Overviews. FAQ-style content with clear answers increases AIO citation chances.",
     "informational"),
    ("high", "Build comparison pages for competitor queries",
     "{n} comparison keywords identified. Detailed comparison content can capture AI Overview citations.",
     "comparison"),
    ("medium", "Add structured pricing data (Schema.org)",
     "{n} cost-related queries found. Structured data helps AI systems extract accurate pricing info.",
     "cost"),
    ("medium", "Claim and optimize knowledge panels",
     "Brand queries are increasingly answered by AI. Ensure Google Knowledge Panel and Wikipedia presence "
     "are accurate and comprehensive.", None),
    ("medium", "Monitor AI chatbot responses",
     "Regularly test prompts in ChatGPT, Perplexity, and Google AI Mode to track brand mention frequency "
     "and accuracy.", None),
    ("low", "Use Semrush AI Visibility tools for ongoing tracking",
     "Semrush offers AI Visibility Overview, Competitor Research, and Prompt Tracking for systematic "
     "monitoring.", None),
]
RECOMMENDATION_TOOLS = [
    "AI Visibility Overview - Track brand mentions across AI platforms",
    "Competitor Research - Compare AI visibility vs competitors",
    "Prompt Research - Find prompts mentioning your brand",
    "Brand Performance - Monitor brand perception in AI",
    "Growth Actions - Get actionable AI visibility improvements",
    "Prompt Tracking - Track specific prompts over time",
]
MAX_REC_KEYWORDS = 5
# --------------------------------------------------------------------------


def classify_triggers(keywords: DataFrame, col: str = "keyword") -> DataFrame:
    """I-02: first matching bucket (informational, comparison, cost,
    recommendation), else transactional.  Substring tests, narrow."""
    low = with_lowered(keywords, col, "__lk")
    return low.withColumn("trigger_category", trigger_category("__lk", lowered=True)).drop("__lk")


def trigger_dim(spark: SparkSession) -> DataFrame:
    rows = [(cat, i + 1, lab) for i, (cat, lab) in enumerate(TRIGGER_LIKELIHOOD)]
    return spark.createDataFrame(rows, "trigger_category string, cat_order int, likelihood string")


def trigger_counts(classified: DataFrame, by=()) -> DataFrame:
    """A-09: keywords per trigger bucket in fixed order, zero buckets kept,
    with the likelihood label.  The 5-row bucket dimension is the
    preserved side of a broadcast-sized join onto the aggregate."""
    counts = classified.groupBy(*by, "trigger_category").agg(F.count(F.lit(1)).alias("n_keywords"))
    if by:
        # every client gets all five buckets: a literal generator, no join
        buckets = F.array(*[F.struct(F.lit(c).alias("trigger_category"), F.lit(i + 1).alias("cat_order"),
                                     F.lit(lab).alias("likelihood"))
                            for i, (c, lab) in enumerate(TRIGGER_LIKELIHOOD)])
        dim = classified.select(*by).distinct().select(*by, F.explode(buckets).alias("b")).select(*by, "b.*")
    else:
        dim = trigger_dim(classified.sparkSession)
    return (dim.join(counts, [*by, "trigger_category"], "left")
            .select(*by, "cat_order", "trigger_category", "likelihood",
                    F.coalesce("n_keywords", F.lit(0)).cast("long").alias("n_keywords")))


def recommendations(classified: DataFrame, seq_col: str, label_col: str, by=()) -> DataFrame:
    """I-03: the six recommendations of each client (``by``); the first three
    carry their bucket's count (in the reason text) and its first five keywords
    in input order.

    One window numbers a bucket's keywords; its group limit keeps five rows a
    task before the shuffle.  The counts, one row per bucket, combine in the
    tasks.  The six texts come from a literal generator."""
    w = W.partitionBy(*by, "trigger_category").orderBy(seq_col)
    first5 = (classified.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= MAX_REC_KEYWORDS)
              .groupBy(*by, "trigger_category")
              .agg(F.array_join(F.transform(
                  F.array_sort(F.collect_list(F.struct(F.col(seq_col).alias("s"), F.col(label_col).alias("l")))),
                  lambda x: x["l"].cast("string")), " | ").alias("keywords")))
    counts = classified.groupBy(*by, "trigger_category").agg(F.count(F.lit(1)).alias("n"))
    texts = F.array(*[F.struct(F.lit(i + 1).alias("rec_order"), F.lit(p).alias("priority"), F.lit(a).alias("action"),
                               F.lit(r).alias("reason_tpl"), F.lit(c).cast("string").alias("trigger_category"))
                      for i, (p, a, r, c) in enumerate(RECOMMENDATIONS)])
    clients = classified.select(*by).distinct() if by else classified.sparkSession.range(1)
    rec = clients.select(*by, F.inline(texts))
    key = [*by, "trigger_category"]
    j = rec.join(counts, key, "left").join(first5, key, "left")
    n = F.coalesce(F.col("n"), F.lit(0)).cast("string")
    reason = F.when(F.col("trigger_category").isNotNull(),
                    F.replace(F.col("reason_tpl"), F.lit("{n}"), n)).otherwise(F.col("reason_tpl"))
    tools = F.when(F.col("rec_order") == len(RECOMMENDATIONS), F.lit(" | ".join(RECOMMENDATION_TOOLS)))
    keywords = F.when(F.col("trigger_category").isNotNull(), F.coalesce(F.col("keywords"), F.lit("")))
    return j.select(*by, "rec_order", "priority", "action", reason.alias("reason"), keywords.alias("keywords"),
                    tools.alias("tools"))


def template_parts(template: str) -> list[tuple[str, str]]:
    """'Is {name} or {target} better?' -> [('lit', 'Is '), ('var', 'name'),
    ('lit', ' or '), ('var', 'target'), ('lit', ' better?')]."""
    import re
    out = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if piece:
            out.append(("var" if i % 2 else "lit", piece))
    return out


def _render(template: str, target: str, item: str | None):
    cols = []
    for kind, piece in template_parts(template):
        if kind == "lit":
            cols.append(F.lit(piece))
        else:
            cols.append(F.col(target) if piece == "target" else F.col(item))
    return F.concat(*cols)


def _template_rows(feeds: str, target: str, item: str | None):
    """Array of (category, cat_order, tpl_order, limit, prompt) structs for
    every template fed by ``feeds``; exploded per input row (a generator,
    not a join)."""
    out = []
    for cat, order, feed, limit, tpls in PROMPT_TEMPLATES:
        if feed != feeds:
            continue
        for j, tpl in enumerate(tpls):
            out.append(F.struct(F.lit(cat).alias("category"), F.lit(order).alias("cat_order"),
                                F.lit(j + 1).alias("tpl_order"),
                                F.lit(limit if limit is not None else 1 << 30).alias("lim"),
                                _render(tpl, target, item).alias("prompt")))
    return F.array(*out)


def build_prompts(targets: DataFrame, keywords: DataFrame, competitors: DataFrame,
                  by=("client_id",)) -> DataFrame:
    """I-01 / J-04: prompt texts per client.

    ``targets``: (by..., target_name); ``keywords``: (by..., seq, keyword)
    market keywords in order (seq from 1); ``competitors``: (by..., seq,
    name) in order (seq from 1).  Each feeds its templates through
    ``explode`` of a literal template array, so no join or cross product
    is planned; a keyword/competitor row only feeds templates whose limit
    covers its position.
    """
    t = targets.select(*by, F.coalesce(F.col("target_name"), F.lit("")).alias("__t"))
    tp = t.select(*by, F.lit(0).alias("item_seq"), F.explode(_template_rows("target", "__t", None)).alias("p"))
    kw = keywords.join(t, list(by)).select(*by, F.col("seq").alias("item_seq"), "__t", "keyword")
    kp = kw.select(*by, "item_seq", F.explode(_template_rows("keyword", "__t", "keyword")).alias("p"))
    cp_in = competitors.join(t, list(by)).select(*by, F.col("seq").alias("item_seq"), "__t", "name")
    cp = cp_in.select(*by, "item_seq", F.explode(_template_rows("competitor", "__t", "name")).alias("p"))
    allp = tp.unionByName(kp).unionByName(cp).filter(F.col("item_seq") <= F.col("p.lim"))
    return allp.select(*by, "p.category", "p.cat_order", "item_seq", "p.tpl_order", "p.prompt")


def prompt_counts(prompts: DataFrame, by=("client_id",), clients: DataFrame | None = None) -> DataFrame:
    """A-10: prompts per category and the total (ROLLUP; category NULL on
    the total rows, everything NULL on the grand total).  With ``clients`` (by...)
    every client has a row for every category, 0 where it has no prompt, and
    clients without any prompt are counted too."""
    if clients is None:
        return prompts.rollup(*by, "category").agg(F.count(F.lit(1)).alias("n_prompts"))
    # the categories are few and fixed: each client row unfolds into them
    names = list(dict.fromkeys(t[0] for t in PROMPT_TEMPLATES))
    every = clients.select(*by).distinct().select(*by, F.explode(F.array(*[F.lit(c) for c in names])).alias("category"))
    counts = prompts.groupBy(*by, "category").agg(F.count(F.lit(1)).alias("n"))
    return (every.join(counts, [*by, "category"], "left").rollup(*by, "category")
            .agg(F.sum(F.coalesce("n", F.lit(0))).alias("n_prompts")))


def brand_mentions(conversations: DataFrame, brands: DataFrame, by=("client_id",)) -> DataFrame:
    """A-16 (our definition): per brand, assistant answers whose lower-cased
    text contains the lower-cased brand, total occurrences, share of voice
    among the client's brands, and prompts tracked (user turns).

    Brands are tested once whatever the number of clients that name them;
    answers meet brands where the answer is read (see :func:`pattern_hits`),
    and one partial count a brand and task is shuffled.
    """
    answers = conversations.filter(F.col("role") == "assistant").select(F.lower("text").alias("__lt"))
    b = brands.select(*by, "brand", F.lower("brand").alias("__lb")).filter(F.length("__lb") > 0)
    hits = pattern_hits(answers, b, "__lt", "__lb")
    occ = (F.length("__lt") - F.length(F.replace(F.col("__lt"), F.col("__lb"), F.lit("")))) / F.length("__lb")
    agg = hits.groupBy("__lb").agg(F.count(F.lit(1)).alias("answers_mentioning"), F.sum(occ.cast("long")).alias("mentions"))
    full = b.join(agg, "__lb", "left").select(
        *by, "brand", F.coalesce("answers_mentioning", F.lit(0)).cast("long").alias("answers_mentioning"),
        F.coalesce("mentions", F.lit(0)).cast("long").alias("mentions"))
    tot = F.sum("answers_mentioning").over(W.partitionBy(*by))
    prompts = conversations.filter(F.col("role") == "user").agg(F.count(F.lit(1)).alias("prompts_tracked"))
    share = F.when(tot > 0, F.col("answers_mentioning").cast("double") / tot.cast("double")).otherwise(F.lit(0.0))
    return full.select("*", dround(share, 6).alias("share_of_voice")).join(F.broadcast(prompts), how="cross")
