"""The pooled spatial mean as a stream: sums, squares and counts by date under a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.filters import KEYS


def streaming_mean(observations: DataFrame, low: float, high: float, late: str = "2 days", keys: list[str] = KEYS) -> DataFrame:
    """Mean, count and sample deviation of each day, given out once the watermark has passed it."""
    ok = observations.where(F.col("value").between(low, high)).withColumn("event", F.col("time").cast("timestamp"))
    day = F.window("event", "1 day")
    out = ok.withWatermark("event", late).groupBy(*keys, day).agg(F.avg("value").alias("vi_raw"), F.count("value").alias("vi_count"), F.stddev_samp("value").alias("vi_std"))
    return out.select(*keys, F.to_date("window.start").alias("date"), "vi_raw", "vi_count", "vi_std")
