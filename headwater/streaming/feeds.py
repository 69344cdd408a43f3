"""Our own extension: feeds as streams, with the same pure functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwater.functions.text import plain_fold


def first_arrivals(stream: DataFrame, title: str, ts: str, delay: str = "2 days") -> DataFrame:
    """One row per folded title within the watermark."""
    return stream.withColumn("title_key", plain_fold(F.col(title))).withWatermark(ts, delay).dropDuplicatesWithinWatermark(["title_key"])


def daily_counts(stream: DataFrame, key: str, ts: str, delay: str = "2 days") -> DataFrame:
    return stream.withWatermark(ts, delay).groupBy(F.window(ts, "1 day"), key).agg(F.count("*").alias("n"))
