"""The tables behind the plots: climatology, anomaly, overlays, panels, thinning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .filters import KEYS


def doy_climatology(frame: DataFrame, value: str = "vi_smooth", keys: list[str] = KEYS) -> DataFrame:
    return frame.where(F.col(value).isNotNull()).groupBy(*keys, F.dayofyear("date").alias("doy")).agg(F.avg(value).alias("mean"))


def anomaly(frame: DataFrame, value: str = "vi_smooth", keys: list[str] = KEYS) -> DataFrame:
    """Value less the mean of its day of year, for series of two calendar years at least."""
    own = frame.where(F.col(value).isNotNull())
    mean = F.avg(value).over(Window.partitionBy(*keys, F.dayofyear("date")))
    span = Window.partitionBy(*keys)
    years = F.max(F.year("date")).over(span) > F.min(F.year("date")).over(span)
    return own.withColumn("__ok", years).withColumn("anomaly", F.col(value) - mean).where("__ok").select(*keys, "date", "anomaly")


def annual_overlay(frame: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """(year, doy, value), of the smoothed curve or, without one, of the daily values."""
    value = F.coalesce("vi_smooth", "vi_daily") if "vi_smooth" in frame.columns else F.col("vi_daily")
    return frame.withColumn("value", value).where("value IS NOT NULL").select(*keys, F.year("date").alias("year"), F.dayofyear("date").alias("doy"), "value")


def deviation_band(series: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Observed means with one deviation either side."""
    d = F.coalesce("vi_std", F.lit(0.0))
    return series.where(F.col("vi_count") > 0).select(*keys, "date", "vi_raw", (F.col("vi_raw") - d).alias("low"), (F.col("vi_raw") + d).alias("high"))


def index_panel(frame: DataFrame, value: str = "vi_smooth") -> DataFrame:
    """Rows of regions that have more than one index."""
    w = Window.partitionBy("region")
    return frame.where(F.col(value).isNotNull()).withColumn("__k", F.min("vi").over(w) < F.max("vi").over(w)).where("__k").select("region", "vi", "date", value)


def every_kth(pixels: DataFrame, most: int, keys: list[str] = KEYS) -> DataFrame:
    """Rows and columns of a map thinned evenly until at most about ``most`` places are left (a display operator)."""
    lines = Window.partitionBy(*keys)
    out = pixels.withColumns({"__i": F.dense_rank().over(lines.orderBy("y")) - 1, "__j": F.dense_rank().over(lines.orderBy("x")) - 1})
    k = F.greatest(F.ceil(F.sqrt(F.count(F.lit(1)).over(lines) / F.lit(float(most)))), F.lit(1))
    return out.withColumn("__k", k).where("__i % __k = 0 AND __j % __k = 0").drop("__i", "__j", "__k")
