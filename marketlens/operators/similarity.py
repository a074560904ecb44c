"""Top-k set-similarity join: for each target set, the k most similar sets by
Jaccard similarity, without meeting all pairs (J-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import checkpointed
from .ranking import grouped_row_number

#: Similarities tried, one after the other, for targets that don't have k yet.
THRESHOLDS = (0.6, 0.3, 0.0)
#: An item is hot when more sets hold it than this, and than a thousandth of
#: all memberships; so there are a thousand hot items at most.
HOT_SETS, HOT_SHARE = 10_000, 1_000
#: Up to so many sets and targets, all sets of an item stand in one row and are
#: counted there; no item is hot then, and no filter saves more than it costs.
FEW_SETS, FEW_TARGETS = 10_000, 64


def hot_items(sizes: DataFrame, memberships: int, hot_sets: int = HOT_SETS) -> DataFrame:
    """(item, salts): items held by many sets, and into how many parts their
    sets are dealt.  At most ``HOT_SHARE`` rows by the rule."""
    bound = max(hot_sets, memberships // HOT_SHARE) if hot_sets == HOT_SETS else hot_sets
    return sizes.filter(F.col("df") > bound).select("item", F.ceil(F.col("df") / bound).cast("int").alias("salts"))


def join_items(sets: DataFrame, asked: DataFrame, hot: DataFrame) -> DataFrame:
    """``sets`` (set_id, item, ...) met with ``asked`` (item, ...) on the item.
    The sets of a hot item are dealt over several keys and what is asked of it
    is repeated for each, so that no task gets all of them."""
    hot = F.broadcast(hot)
    left = sets.join(hot, "item", "left").withColumn(
        "salt", F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64("set_id"), F.col("salts")).cast("int")).otherwise(F.lit(0)))
    right = asked.join(hot, "item", "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
    return left.drop("salts").join(right.drop("salts"), ["item", "salt"]).drop("salt")


def _ranked(sized: DataFrame) -> DataFrame:
    """(target, set_id, shared, score, rank) of (target, set_id, n_target, n, shared)."""
    score = F.col("shared").cast("double") / (F.col("n_target") + F.col("n") - F.col("shared")).cast("double")
    order = W.partitionBy("target").orderBy(F.desc("score"), "set_id")
    best = sized.select("target", "set_id", "shared", score.alias("score"))
    return best.withColumn("rank", F.row_number().over(order))


def _among_few(members: DataFrame, targets: DataFrame, k: int) -> DataFrame:
    """``top_k_similar`` of few targets among few sets: the sets of each item are
    brought together once, and the targets among them meet the others there;
    what is shuffled after that is counts."""
    by_item = checkpointed(members.groupBy("item").agg(F.collect_set("set_id").alias("sets")))
    n_sets = by_item.select(F.explode("sets").alias("set_id")).groupBy("set_id").agg(F.count(F.lit(1)).alias("n"))
    own = by_item.select("sets", F.explode("sets").alias("target")).join(F.broadcast(targets), "target")
    met = (own.select("target", F.explode("sets").alias("set_id")).filter(F.col("set_id") != F.col("target"))
           .groupBy("target", "set_id").agg(F.count(F.lit(1)).alias("shared")))
    size_of = n_sets.select(F.col("set_id").alias("target"), F.col("n").alias("n_target"))
    return _ranked(met.join(size_of, "target").join(n_sets, "set_id")).filter(F.col("rank") <= k)


def top_k_similar(members: DataFrame, targets: DataFrame, k: int = 10, thresholds=THRESHOLDS,
                  hot_sets: int = HOT_SETS, few_sets: int = FEW_SETS, few_targets: int = FEW_TARGETS) -> DataFrame:
    """(target, set_id, shared, score, rank): the ``k`` sets most similar to each
    target (score descending, then set_id), the target itself and sets that
    share nothing excluded; fewer rows where fewer sets share an item.

    ``members``: (set_id, item), repeats allowed; ``targets``: (target), names
    of sets.  Rows with a null are left out.

    Prefix filtering (Chaudhuri et al., 2006; Xiao et al., 2011): with the
    items of a target A in order of rarity, a set B of similarity t or more
    holds one of the first p = |A| - ceil(t |A|) + 1, its size lies in
    [t |A|, |A| / t], and of these p items it holds enough for
    t / (1 + t) (|A| + |B|) shared ones if it held all the others.  Sets that
    pass are counted whole.  The targets go through falling thresholds, each
    meeting only the items after the last one's; a target that has k sets of
    similarity t is done, so the frequent items, last in the order, are met
    only for targets without k similar sets.  The result is exact.  Hot items
    are salted; the driver sees a number a round.  With ``few_sets`` sets and
    ``few_targets`` targets at most, they are counted item by item instead.
    """
    m = members.select("set_id", "item").filter(F.col("set_id").isNotNull() & F.col("item").isNotNull())
    t = targets.select(F.col("target")).filter(F.col("target").isNotNull()).distinct()
    if t.count() <= few_targets:
        m = checkpointed(m)
        if m.select("set_id").distinct().count() <= few_sets:
            return _among_few(m, t, k)
    m = checkpointed(m.distinct())
    n_sets = m.groupBy("set_id").agg(F.count(F.lit(1)).alias("n"))
    df = m.groupBy("item").agg(F.count(F.lit(1)).alias("df"))
    hot = checkpointed(hot_items(df, m.count(), hot_sets))
    own = m.join(t, m.set_id == t.target, "left_semi")
    # rarity: the frequency of an item joined to the targets that hold it
    spread = join_items(own, df, hot).withColumnRenamed("set_id", "target")
    placed = grouped_row_number(spread, ["target"], [F.asc("df"), F.asc("item")], "place")
    size_of = n_sets.select(F.col("set_id").alias("target"), F.col("n").alias("n_target"))
    placed = checkpointed(placed.join(size_of, "target").select("target", "item", "place", "n_target"))
    done, open_, met, last = None, t, None, F.lit(0)
    for threshold in thresholds:
        p = F.col("n_target") - F.ceil(F.col("n_target") * threshold - 1e-9) + F.lit(1 if threshold > 0 else 0)
        left = placed.join(open_, "target", "left_semi")
        some = join_items(m, left.filter((F.col("place") > last) & (F.col("place") <= p)).select("target", "item"), hot)
        counted = some.filter(F.col("set_id") != F.col("target")).groupBy("target", "set_id").agg(F.count(F.lit(1)).alias("c"))
        if met is not None:
            counted = (met.join(open_, "target", "left_semi").unionByName(counted)
                       .groupBy("target", "set_id").agg(F.sum("c").alias("c")))
        met, last = (checkpointed(counted) if threshold > 0 else counted), p
        sized = met.join(size_of, "target").join(n_sets, "set_id")
        shared = F.col("c")
        if threshold > 0:
            enough = F.lit(threshold / (1 + threshold)) * (F.col("n_target") + F.col("n")) - 1e-6
            fits = (F.col("n") >= F.col("n_target") * threshold - 1e-6) & (F.col("n") * threshold <= F.col("n_target") + 1e-6)
            sized = checkpointed(sized.filter(fits & (F.col("c") + F.col("n_target") - p >= enough)))
            rest = (left.filter(F.col("place") > p).select("target", "item").join(sized.select("target", "set_id"), "target")
                    .join(m, ["set_id", "item"], "left_semi").groupBy("target", "set_id").agg(F.count(F.lit(1)).alias("more")))
            sized = sized.join(rest, ["target", "set_id"], "left")
            shared = F.col("c") + F.coalesce("more", F.lit(0))
        sized = sized.withColumn("shared", shared)
        best = _ranked(sized).filter(F.col("rank") <= k)
        if threshold > 0:
            best = checkpointed(best)
            full = best.filter((F.col("rank") == k) & (F.col("score") >= threshold)).select("target")
            best, open_ = best.join(full, "target", "left_semi"), checkpointed(open_.join(full, "target", "left_anti"))
        done = best if done is None else done.unionByName(best)
        if threshold > 0 and open_.isEmpty():
            break
    return done
