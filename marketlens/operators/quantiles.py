"""Exact quantiles of grouped values by counting passes over value ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import checkpointed

#: Ranges that a pass counts in each group.
RANGES = 4096
#: Distinct values of a group that may be put in order in one task.
FEW = 65_536


def upper_median(counts: DataFrame, by, value: str, weight: str, name: str = "median", ranges: int = RANGES,
                 few: int = FEW) -> DataFrame:
    """(by..., name): ``sorted(values)[n // 2]`` of each group, exactly.

    ``counts``: (by..., value, weight), one row per distinct value of a group and
    how often it occurs.  Null values don't count; a group without a value has
    no row.  Groups may be named by nulls.

    A pass counts the values of each group in ``ranges`` equal ranges between
    its smallest and largest open value (partial counts, so a group that holds
    most of the rows sends ``ranges`` rows a task) and keeps the range in which
    the median lies, shrunk to the values in it.  Passes end when no open range
    has more than ``few`` distinct values; money values need two at most,
    whatever their number.  Then the values of the last ranges are put in
    order.  No task holds a group.
    """
    by = list(by)
    v = counts.filter(F.col(value).isNotNull()).select(
        F.struct(*[F.col(c) for c in by], F.lit(0)).alias("__g"), F.col(value).cast("double").alias("__v"), F.col(weight).alias("__n"))
    # what is still open of each group: [low, high], its distinct values, and the rank looked for in it
    state = v.groupBy("__g").agg(F.min("__v").alias("__low"), F.max("__v").alias("__high"), F.count(F.lit(1)).alias("__rows"),
                                 F.floor(F.sum("__n") / 2).alias("__rank"))
    state = checkpointed(state)

    def open_values():
        # a group is named by a struct, which is equal to itself where its fields are null
        return v.join(state, "__g").filter((F.col("__v") >= F.col("__low")) & (F.col("__v") <= F.col("__high")))

    while not state.filter((F.col("__rows") > few) & (F.col("__low") < F.col("__high"))).isEmpty():
        share = (F.col("__v") - F.col("__low")) / (F.col("__high") - F.col("__low"))
        spot = F.when(F.col("__high") > F.col("__low"), F.least(F.floor(share * ranges), F.lit(ranges - 1))).otherwise(F.lit(0))
        each = open_values().groupBy("__g", "__rank", spot.alias("__range")).agg(
            F.sum("__n").alias("__n"), F.min("__v").alias("__low"), F.max("__v").alias("__high"), F.count(F.lit(1)).alias("__rows"))
        before = F.sum("__n").over(W.partitionBy("__g").orderBy("__range")) - F.col("__n")
        state = checkpointed(each.withColumn("__before", before)
                             .filter((F.col("__rank") >= F.col("__before")) & (F.col("__rank") < F.col("__before") + F.col("__n")))
                             .select("__g", "__low", "__high", "__rows", (F.col("__rank") - F.col("__before")).alias("__rank")))
    # few values or a single one are left of each group
    last = open_values().select("__g", "__v", "__n", "__rank")
    before = F.sum("__n").over(W.partitionBy("__g").orderBy("__v")) - F.col("__n")
    found = last.withColumn("__before", before).filter(
        (F.col("__rank") >= F.col("__before")) & (F.col("__rank") < F.col("__before") + F.col("__n")))
    return found.select(*[F.col("__g").getField(c).alias(c) for c in by], F.col("__v").alias(name))
