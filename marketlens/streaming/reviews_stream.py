"""The stateless review operators under Structured Streaming.

Not a capability of the source tool (it has no streaming); the same column
expressions (X-13, X-14, F-02, F-03) run unchanged on a stream of review
records, and complaint counts are kept per event-time window behind a
watermark, so late records within the allowed delay still count and the
state for closed windows is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reviews import filter_negative, score_reviews
from ..sources.sinks import REVIEW_SCHEMA


def review_stream(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Streaming source of review records (explicit schema, new files only)."""
    return spark.readStream.schema(REVIEW_SCHEMA).format(fmt).load(path)


def windowed_complaints(reviews: DataFrame, window: str = "1 day", watermark: str = "2 days") -> DataFrame:
    """Negative reviews per (event-time window, category): substantive
    reviews (> 10 characters) are scored, filtered and exploded exactly as
    in batch; the count is a stateful aggregation bounded by the watermark."""
    neg = filter_negative(score_reviews(reviews.filter(F.length("text") > 10)))
    ex = neg.select("scraped_at", F.explode_outer("categories").alias("category"))
    return (ex.withWatermark("scraped_at", watermark)
            .groupBy(F.window("scraped_at", window).alias("window"), "category")
            .agg(F.count(F.lit(1)).alias("n_reviews")))


def start_to_memory(df: DataFrame, name: str, checkpoint: str, mode: str = "update"):
    """Run the aggregation into an in-memory table (tests, notebooks).
    Production jobs write with ``foreachBatch`` or a file/table sink and
    keep ``checkpoint`` on the cluster's shared file system."""
    return (df.writeStream.outputMode(mode).format("memory").queryName(name)
            .option("checkpointLocation", checkpoint).start())
