"""URL filters (operator 9): host and path rules, and gradient-boosted trees on
lexical features for URLs that no rule names.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end; both empty
without ``://`` or for null.  A rule fits its host and all subdomains if the
path starts with the rule's path; the longest rule (host, then path) wins.

The trees learn from labelled URLs; query op9 takes those that the rules
label.  Features of a URL: its length, depth, digit ratio, character entropy,
parameter counts and the blocked share of the labelled URLs with its suffix
(the last label, and the last two labels, of the host; smoothed towards the
overall share).  Labelled rows are counted by URL and about ``SAMPLE`` of them
are learned from: each URL with its share of the rows as weight, rounded by a
hash, so at most about ``SAMPLE`` URLs; suffix shares count all rows.

Everything is DataFrame expressions and Spark's own trees; suffix tables are
joined, never collected.  Null or odd URLs get empty parts and are judged like
others.  No labelled URL, or labels of one kind only: the verdict for the rest
is that kind, or ``allow`` where there is none.  Repeated rows are judged each.
Empty table: empty result.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
SAMPLE, TREES, DEPTH = 20_000, 20, 4
#: Labelled URLs' weight of the overall share in a suffix's share.
PRIOR = 20.0
FEATURES = ("length", "depth", "digit_ratio", "entropy", "n_params", "param_chars", "share_1", "share_2")


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Add host, path and query columns."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
    part = lambda k: F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), pattern, k)
    return df.withColumns({"host": lower_ascii(part(1)), "path": part(2), "query": part(3)})


def rule_of(rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits host and path, or null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def lexical(df: DataFrame) -> DataFrame:
    """Add the lexical features of url, host, path and query."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    size = F.greatest(F.length(url), F.lit(1)).cast("double")
    entropy = F.expr("""aggregate(transform(array_distinct(split(u, '')), c -> length(u) - length(replace(u, c, ''))), 0D,
                        (s, n) -> s - if(n > 0, n / length(u) * ln(n / length(u)), 0D))""")
    return (df.withColumn("u", url).withColumns({
        "length": F.length("u").cast("double"),
        "depth": F.size(F.expr("filter(split(path, '/'), x -> x <> '')")).cast("double"),
        "digit_ratio": F.length(F.regexp_replace("u", "[^0-9]", "")) / size,
        "entropy": entropy,
        "n_params": F.size(F.expr("filter(split(query, '&'), x -> x <> '')")).cast("double"),
        "param_chars": F.length("query").cast("double"),
        "suffix_1": F.substring_index("host", ".", -1), "suffix_2": F.substring_index("host", ".", -2)}).drop("u"))


def suffix_shares(labelled: DataFrame, overall: float) -> list[DataFrame]:
    """Per suffix the smoothed share of blocked labelled URLs."""
    share = (F.sum("label") + F.lit(PRIOR * overall)) / (F.count(F.lit(1)) + F.lit(PRIOR))
    return [labelled.groupBy(f"suffix_{k}").agg(share.alias(f"share_{k}")) for k in (1, 2)]


def with_shares(df: DataFrame, shares: list[DataFrame], overall: float) -> DataFrame:
    for k, table in enumerate(shares, 1):
        df = df.join(table, f"suffix_{k}", "left").withColumn(f"share_{k}", F.coalesce(f"share_{k}", F.lit(overall)))
    return df


def drawn(labelled: DataFrame, part: float) -> DataFrame:
    """(url, label, weight): each URL's ``part`` of its rows, rounded up or
    down by a hash; URLs of weight 0 are left out."""
    rounding = F.pmod(F.xxhash64("url", F.lit("sample")), F.lit(1_000_000)) / 1_000_000
    urls = labelled.groupBy("url").agg(F.count(F.lit(1)).alias("n"), F.first("label").alias("label"))
    return urls.select("url", "label", F.floor(F.col("n") * part + rounding).cast("double").alias("weight")).where("weight > 0")


def judged(df: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, sample: int = SAMPLE) -> DataFrame:
    """One row per input row: the id, host, path, rule, verdict and the trees'
    block probability (null where a rule decides)."""
    rule, says = rule_of(rules)
    rows = lexical(url_parts(df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))))
    rows = rows.withColumns({"rule": rule, "says": says})
    labelled = rows.where("says is not null").withColumn("label", (F.col("says") == "block").cast("double"))
    n, blocked = labelled.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < blocked < n:
        rest = "block" if blocked else "allow"
        return rows.select("page_id", "host", "path", "rule", F.coalesce("says", F.lit(rest)).alias("verdict"),
                           F.when(F.col("says").isNull(), F.lit(float(blocked > 0))).alias("block_probability"))
    overall = blocked / n
    shares = [stored(t, "suffix-shares") for t in suffix_shares(labelled, overall)]
    part = min(1.0, sample / n)
    some = lexical(url_parts(drawn(labelled, part)))
    some = with_shares(some, shares, overall).select("label", "weight", *FEATURES)
    some = stored(some.repartition(4), "url-sample")  # a bounded number of rows
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    trees = GBTClassifier(labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, checkpointInterval=-1)
    two = some.agg(F.min("label"), F.max("label")).first()
    if two[0] is None or two[0] == two[1]:  # a sample of one kind only
        model, chance = None, F.lit(overall)
    else:
        model = trees.fit(vector.transform(some))
    scored = with_shares(rows, shares, overall)
    if model is not None:
        scored = model.transform(vector.transform(scored)).withColumn("p", vector_to_array("probability")[1])
    else:
        scored = scored.withColumn("p", chance)
    chosen = F.coalesce("says", F.when(F.col("p") >= 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", chosen.alias("verdict"),
                         F.when(F.col("says").isNull(), F.col("p")).alias("block_probability"))


def digest(pages: DataFrame) -> DataFrame:
    """The contract's columns of query op9."""
    return judged(pages)
