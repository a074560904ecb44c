"""Traffic analytics over an event log (T-01 ... T-06, K-13 trend part).

Definitions (ours; the source tool only screenshots a vendor's views):

* A session starts when the same user's gap to the previous event
  (ordered by ts, event_id) exceeds ``gap_s`` seconds; a bounce is a
  one-event session; transitions link consecutive events of one session,
  probability = n / sum of n over the same ``from`` type.
* Shares are over the grand total; trends are per calendar day (UTC) over
  the days present, the moving average over up to 7 present rows; growth
  = value / previous present value - 1, NULL when there is none or it is 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import dround


def sessionize(events: DataFrame, gap_s: int = 1800, user: str = "user_id", ts: str = "ts",
               tie: str = "event_id", kind: str = "event_type", bucket: str = "hour") -> DataFrame:
    """Per-event session flags without funnelling a user into one task.

    The ordered window runs per (user, time bucket), so a user holding a
    third of all events is still spread over many tasks.  Each bucket's
    first/last event is summarised (one row per user-bucket), neighbouring
    buckets are looked up over that small summary, and joined back on
    (user, bucket) -- the events side is already partitioned by that key,
    so the join adds no shuffle of the events.

    Adds: ``is_start``, ``is_end`` (session boundaries) and ``next_kind``
    (the next event's type inside the same session, else NULL).
    """
    e = events.select(user, ts, tie, kind, F.date_trunc(bucket, ts).alias("__b"))
    w = W.partitionBy(user, "__b").orderBy(ts, tie)
    e = e.withColumns({"__prev_ts": F.lag(ts).over(w), "__next_ts": F.lead(ts).over(w),
                       "__next_kind": F.lead(kind).over(w)})
    key = F.struct(F.col(ts), F.col(tie))
    summ = e.groupBy(user, "__b").agg(
        F.min_by(F.struct(F.col(ts).alias("t"), F.col(kind).alias("k")), key).alias("__first"),
        F.max_by(F.col(ts), key).alias("__last_ts"))
    wb = W.partitionBy(user).orderBy("__b")
    summ = summ.select(user, "__b", F.lag("__last_ts").over(wb).alias("__before_ts"),
                       F.lead("__first").over(wb).alias("__after"))
    j = e.join(summ, [user, "__b"])
    prev_ts = F.coalesce(F.col("__prev_ts"), F.col("__before_ts"))
    has_next_in = F.col("__next_ts").isNotNull()
    next_ts = F.when(has_next_in, F.col("__next_ts")).otherwise(F.col("__after.t"))
    next_kind = F.when(has_next_in, F.col("__next_kind")).otherwise(F.col("__after.k"))
    secs = lambda a, b: (F.unix_micros(a.cast("timestamp")) - F.unix_micros(b.cast("timestamp"))).cast("double") / 1e6
    is_start = prev_ts.isNull() | (secs(F.col(ts), prev_ts) > gap_s)
    is_end = next_ts.isNull() | (secs(next_ts, F.col(ts)) > gap_s)
    return j.select(user, ts, tie, kind, is_start.alias("is_start"), is_end.alias("is_end"),
                    F.when(~is_end, next_kind).alias("next_kind"))


def traffic_overview(events: DataFrame, gap_s: int = 1800) -> DataFrame:
    """T-01: visits (sessions), unique users, events, events per visit,
    bounce rate (one-event sessions / sessions).  ``count_distinct`` is
    exact; ``approx_count_distinct`` is the drop-in at very large scale."""
    s = sessionize(events, gap_s)
    agg = s.agg(F.count_if("is_start").alias("visits"), F.count_distinct("user_id").alias("unique_users"),
                F.count(F.lit(1)).alias("events"),
                F.count_if(F.col("is_start") & F.col("is_end")).alias("bounces"))
    v = F.col("visits").cast("double")
    return agg.select("visits", "unique_users", "events",
                      dround(F.when(v > 0, F.col("events") / v).otherwise(0.0), 6).alias("events_per_visit"),
                      dround(F.when(v > 0, F.col("bounces") / v).otherwise(0.0), 6).alias("bounce_rate"))


def channel_share(events: DataFrame) -> DataFrame:
    """T-02: events and value per event type with their share of the total
    (the total is a window over the handful of aggregated rows)."""
    agg = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"),
                                           F.sum("value").alias("value"))
    all_ = W.partitionBy(F.lit(1))
    return agg.select("event_type", "n_events", dround("value", 4).alias("value"),
                      dround(F.col("n_events") / F.sum("n_events").over(all_), 6).alias("share_events"),
                      dround(F.col("value") / F.sum("value").over(all_), 6).alias("share_value"))


def journeys(events: DataFrame, gap_s: int = 1800) -> DataFrame:
    """T-03: step-to-step transition counts and probabilities."""
    s = sessionize(events, gap_s).filter(F.col("next_kind").isNotNull())
    agg = s.groupBy(F.col("event_type").alias("from_type"), F.col("next_kind").alias("to_type")).agg(
        F.count(F.lit(1)).alias("n"))
    tot = F.sum("n").over(W.partitionBy("from_type"))
    return agg.select("from_type", "to_type", "n", dround(F.col("n") / tot, 6).alias("probability"))


def daily_trend(events: DataFrame) -> DataFrame:
    """T-04: events and users per UTC day, change vs the previous present
    day and the 7-row moving average.  The window runs over one row per
    day (the aggregate), never over raw events."""
    d = events.groupBy(F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("users"))
    w = W.orderBy("day")
    prev = F.lag("events").over(w)
    return d.select("day", "events", "users",
                    dround(F.when(prev > 0, F.col("events") / prev - 1), 6).alias("change"),
                    dround(F.avg("events").over(w.rowsBetween(-6, 0)), 6).alias("moving_avg_7"))


def geo_distribution(orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """T-05: order value and customers by region and nation with ROLLUP
    subtotals and share of the grand total.  nation (25 rows) and region
    (5 rows) are fixed-size dimensions, broadcast."""
    geo = (nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
           .select("n_nationkey", "n_name", "r_name"))
    j = (orders.select("o_custkey", "o_totalprice")
         .join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
         .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey")))
    r = j.rollup("r_name", "n_name").agg(F.sum("o_totalprice").alias("value"),
                                        F.count_distinct("o_custkey").alias("customers"))
    grand = F.max(F.when(F.col("r_name").isNull() & F.col("n_name").isNull(), F.col("value"))).over(
        W.partitionBy(F.lit(1)))
    return r.select(F.col("r_name").alias("region"), F.col("n_name").alias("nation"),
                    dround("value", 2).alias("value"), "customers",
                    dround(F.col("value") / grand, 6).alias("share"))


def keyword_trend(facts: DataFrame) -> DataFrame:
    """T-06: traffic per (keyword, month) and growth vs the keyword's
    previous present month.  The window is per keyword over monthly
    aggregates (a handful of rows per keyword)."""
    m = facts.groupBy("keyword", F.trunc("day", "month").alias("month")).agg(F.sum("qty").alias("traffic"))
    prev = F.lag("traffic").over(W.partitionBy("keyword").orderBy("month"))
    return m.select("keyword", "month", "traffic",
                    dround(F.when(prev > 0, F.col("traffic") / prev - 1), 6).alias("growth"))
