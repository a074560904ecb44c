"""Connected components of a link table, by alternating large-star and
small-star steps (Kiveris et al., "Connected Components in MapReduce and
Beyond", 2014).  Every step is a grouped minimum and a join; only one number a
round reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest
    node reachable.  Empty links: empty result.  Loops and repeats are fine."""
    pairs = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    pairs = stored(pairs, name)
    while True:
        # large star: a node's larger neighbours move to its smallest neighbour
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.where("b > a").join(stored(low, name), "a").select(F.col("low").alias("a"), "b").distinct()
        # small star: a node and its smaller neighbours move to the smallest
        large = stored(large, name)
        low = stored(large.groupBy("b").agg(F.min("a").alias("low")), name)
        small = (large.join(low, "b").where("a > low").select(F.col("low").alias("a"), F.col("a").alias("b"))
                 .unionByName(low.select(F.col("low").alias("a"), "b")).distinct())
        small = stored(small, name)
        # done when no node is both a root and below another root
        open_ = small.join(small.select(F.col("b").alias("a")).distinct(), "a", "left_semi").limit(1).count()
        twice = small.groupBy("b").count().where("count > 1").limit(1).count()
        pairs = small
        if not open_ and not twice:
            break
    roots = pairs.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
