"""Spatial and temporal aggregates; all are partial and final hash aggregates on one exchange."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .filters import KEYS


def tile_stats(df: DataFrame, keys: tuple[str, ...] = ("vi", "region", "tile", "time"), value: str = "value") -> DataFrame:
    """Mean, count and population deviation of every time step of a tile."""
    return df.groupBy(*keys).agg(F.avg(value).alias("vi_raw"), F.count(value).alias("vi_count"), F.stddev_pop(value).alias("vi_std"))


def time_axis(df: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Every date that a series has, valid values or not."""
    return df.select(*keys, "date").distinct()


def spatial_mean(df: DataFrame, axis: DataFrame | None = None, keys: list[str] = KEYS, value: str = "value") -> DataFrame:
    """Pooled mean, count and sample deviation by date; with ``axis``, dates without values stay with count 0."""
    out = df.groupBy(*keys, "date").agg(F.avg(value).alias("vi_raw"), F.count(value).alias("vi_count"), F.stddev_samp(value).alias("vi_std"))
    if axis is None:
        return out
    return axis.join(out, [*keys, "date"], "left").withColumn("vi_count", F.coalesce("vi_count", F.lit(0)))


def spatial_median(df: DataFrame, keys: list[str] = KEYS, value: str = "value") -> DataFrame:
    """Median by date, with the interquartile range (null for one value) in the deviation's place."""
    q = F.percentile(value, F.array(F.lit(0.5), F.lit(0.75), F.lit(0.25)))
    out = df.groupBy(*keys, "date").agg(q.alias("__q"), F.count(value).alias("vi_count"))
    return out.select(*keys, "date", F.col("__q")[0].alias("vi_raw"), "vi_count", F.when(F.col("vi_count") > 1, F.col("__q")[1] - F.col("__q")[2]).alias("vi_std"))


def pixel_stats(df: DataFrame, keys: list[str] = KEYS, value: str = "value") -> DataFrame:
    """Sum, count and mean over time of every place, places rounded to a decimal (half to even)."""
    return df.groupBy(*keys, F.bround("y", 1).alias("y"), F.bround("x", 1).alias("x")).agg(F.sum(value).alias("total"), F.count(value).alias("n_valid"), F.avg(value).alias("mean"))


def percentiles(value: str | Column, prefix: str = "") -> Column:
    """Exact median and 5th and 95th percentiles, linear between values, as one struct."""
    p = F.percentile(value, F.array(F.lit(0.5), F.lit(0.05), F.lit(0.95)))
    return p.alias(f"{prefix}percentiles")


def coefficient_of_variation(value: str = "vi_raw", population: bool = False) -> Column:
    mean = F.avg(value)
    return F.when(mean > 0, (F.stddev_pop(value) if population else F.stddev_samp(value)) / mean)


def dominant(df: DataFrame, group: str, weight: Column | None = None) -> DataFrame:
    """The group of the largest total weight, ties to the first by name: one row."""
    sums = df.groupBy(group).agg(F.sum(weight if weight is not None else F.lit(1)).alias("weight"))
    return sums.orderBy(F.col("weight").desc(), group).limit(1)


def run_stats(df: DataFrame, keys: list[str], low: float, high: float) -> DataFrame:
    """Dates, dates with a valid value, and valid values."""
    ok = F.col("value").between(low, high)
    return df.groupBy(*keys).agg(F.countDistinct("date").alias("n_dates"), F.countDistinct(F.when(ok, F.col("date"))).alias("n_valid_dates"), F.count_if(ok).alias("total_pixels"))


def extent(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[f(c).alias(f"{n}_{c}") for c in ("y", "x") for n, f in (("min", F.min), ("max", F.max))])


def unpivot_summary(df: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Mean, population deviation, percentiles and count of each metric over space."""
    long = df.unpivot(keys, metrics, "metric", "v").where(F.col("v").isNotNull())
    p = F.percentile("v", F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95)))
    out = long.groupBy(*keys, "metric").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), p.alias("__p"), F.count("v").alias("n_valid_pixels"))
    return out.select(*keys, "metric", "mean", "std", F.col("__p")[0].alias("p05"), F.col("__p")[1].alias("p50"), F.col("__p")[2].alias("p95"), "n_valid_pixels")


def display_stretch(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """2nd and 98th percentiles, kept apart."""
    p = F.percentile(value, F.array(F.lit(0.02), F.lit(0.98)))
    out = df.groupBy(*keys).agg(p.alias("__p"))
    low, high = F.col("__p")[0], F.col("__p")[1]
    return out.select(*keys, low.alias("low"), F.when(high == low, high + 1e-6).otherwise(high).alias("high"))
