"""Distributed global ranking.

``row_number() over (order by ...)`` without a partition runs in a single
task.  For an unbounded input we instead range-partition on the sort key,
number rows inside each range partition, and add the row count of all
earlier partitions (a table with one row per partition, broadcast).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import checkpointed


def global_row_number(df: DataFrame, order: list[Column], name: str = "rank",
                      num_partitions: int | None = None) -> DataFrame:
    """Attach a 1-based global row number in ``order`` (must be a total
    order for a deterministic result) without funnelling rows into one task."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Materialise the range partitioning once (reliable checkpoint to the
    # shared spark.checkpoint.dir): the numbering and the partition sizes
    # below must see the same partition of every row, and two independent
    # range shuffles may sample different bounds.
    ranged = checkpointed(df.repartitionByRange(n, *order).withColumn("__pid", F.spark_partition_id()))
    local = ranged.withColumn("__local", F.row_number().over(W.partitionBy("__pid").orderBy(*order)))
    sizes = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # one row per range partition: bounded by the partition count
    offsets = sizes.select("__pid", (F.sum("__n").over(W.orderBy("__pid")) - F.col("__n")).alias("__off"))
    return (local.join(F.broadcast(offsets), "__pid")
            .withColumn(name, (F.col("__off") + F.col("__local")).cast("long"))
            .drop("__pid", "__local", "__off"))


def grouped_row_number(df: DataFrame, keys: list[str], order: list[Column], name: str = "position",
                       num_partitions: int | None = None) -> DataFrame:
    """``row_number() over (partition by keys order by order)`` for *all*
    rows of every group, safe when one group holds a large share of the
    data.

    A plain window sends each group whole to one task.  Here the rows are
    range-partitioned on (keys, order), so a hot group is cut across many
    range partitions; rows are numbered inside each (range, group) piece,
    and each piece adds the row count of the same group's earlier pieces
    (one row per piece: a small table).  ``order`` must be a total order
    inside a group for a deterministic result.
    """
    n = num_partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    n = int(n)
    # one consistent partitioning for both uses below (see global_row_number)
    ranged = checkpointed(df.repartitionByRange(n, *[F.col(k) for k in keys], *order).withColumn(
        "__pid", F.spark_partition_id()))
    local = ranged.withColumn("__local", F.row_number().over(W.partitionBy("__pid", *keys).orderBy(*order)))
    pieces = ranged.groupBy("__pid", *keys).agg(F.count(F.lit(1)).alias("__n"))
    offsets = pieces.select("__pid", *keys, (F.sum("__n").over(W.partitionBy(*keys).orderBy("__pid"))
                                             - F.col("__n")).alias("__off"))
    return (local.join(offsets, ["__pid", *keys])
            .withColumn(name, (F.col("__off") + F.col("__local")).cast("int"))
            .drop("__pid", "__local", "__off"))


#: Serials that a piece of rows of one value may span, and so its most rows.
BLOCK = 1 << 20


def value_row_number(df: DataFrame, keys: list[str], value: str, then: list[str], serial: str, name: str = "rank",
                     ranges: int | None = None, block: int = BLOCK) -> DataFrame:
    """1-based number of every row of its group (``keys``), by ``value``
    descending (nulls last), the few-valued ``then`` columns ascending and
    ``serial``, an integer that no two rows of a group share.  Nulls in
    ``then`` or ``serial`` come first; groups may be named by nulls.

    Nothing is stored.  One aggregation takes up to ``ranges`` + 1 quantiles of
    each group as bounds.  Rows between two bounds are one piece; rows *on* a
    bound, where every value shared by a large part of the group must lie, are
    cut further by ``then`` and by blocks of ``block`` serials, so that a piece
    is at most such a block or about a ``ranges``-th of its group.  A counting
    pass gives each piece's offset (first over the ranges of a group, then over
    the pieces of a range), and rows are numbered within their pieces.
    """
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = F.struct(*[F.col(k) for k in keys], F.lit(0).alias("__any"))
    quantiles = F.percentile_approx(value, [i / n for i in range(n + 1)], F.lit(max(10_000, 20 * n)))
    bounds = df.groupBy(group.alias("__g")).agg(
        F.coalesce(F.array_distinct(quantiles), F.array().cast("array<double>")).alias("__bounds"))
    v = F.col(value).cast("double")
    above = F.size(F.filter("__bounds", lambda b: b > v))
    on = v.isNull() | F.array_contains("__bounds", v)
    spot = F.when(v.isNull(), F.size("__bounds")).otherwise(above) * 2 + F.when(on, 1).otherwise(0)
    placed = df.withColumn("__g", group).join(
        bounds.withColumn("__bounds", F.transform("__bounds", lambda b: b.cast("double"))), "__g").withColumn("__on", on)
    inner = [F.when(F.col("__on"), F.col(c)).alias(c) for c in then]
    inner.append(F.when(F.col("__on"), F.floor(F.col(serial) / block)).alias("__block"))
    placed = placed.withColumns({"__range": F.struct("__g", spot.alias("spot")), "__piece": F.struct(*inner)}).drop(
        "__g", "__bounds", "__on")
    pieces = placed.groupBy("__range", "__piece").agg(F.count(F.lit(1)).alias("__n"))
    totals = pieces.groupBy("__range").agg(F.sum("__n").alias("__n"))
    by_range = W.partitionBy(F.col("__range").getField("__g")).orderBy(F.col("__range").getField("spot"))
    starts = totals.select("__range", (F.sum("__n").over(by_range) - F.col("__n")).alias("__start"))
    by_piece = W.partitionBy("__range").orderBy("__piece")
    offsets = pieces.withColumn("__off", F.sum("__n").over(by_piece) - F.col("__n")).join(starts, "__range").select(
        "__range", "__piece", (F.col("__off") + F.col("__start")).alias("__off"))
    order = [F.desc_nulls_last(value), *[F.asc_nulls_first(c) for c in (*then, serial)]]
    numbered = placed.withColumn("__local", F.row_number().over(W.partitionBy("__range", "__piece").orderBy(*order)))
    return (numbered.join(offsets, ["__range", "__piece"])
            .withColumn(name, F.col("__off") + F.col("__local"))
            .drop("__range", "__piece", "__off", "__local"))
