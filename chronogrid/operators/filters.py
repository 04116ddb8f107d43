"""Masks and row filters; each keeps the raw column in the predicate, so that it reaches the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["vi", "region"]


def valid_range(df: DataFrame, low: float, high: float, value: str = "value") -> DataFrame:
    """Rows within the bounds, both included; nulls and NaN go."""
    return df.where(F.col(value).between(low, high))


def valid_ranges(df: DataFrame, ranges: dict[str, tuple[float, float]], value: str = "value") -> DataFrame:
    """As valid_range, by index; indices without a range go."""
    keep = F.lit(False)
    for vi, (low, high) in ranges.items():
        keep = keep | ((F.col("vi") == vi) & F.col(value).between(low, high))
    return df.where(keep)


def mask_range(df: DataFrame, low: float, high: float, value: str = "value") -> DataFrame:
    """All rows; values outside the bounds become null."""
    return df.withColumn(value, F.when(F.col(value).between(low, high), F.col(value)))


def date_range(df: DataFrame, start: str | None = None, end: str | None = None, time: str = "time") -> DataFrame:
    """Rows of the days start to end, both included."""
    if start is not None:
        df = df.where(F.col(time) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        df = df.where(F.col(time) < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz"))
    return df


def with_date(df: DataFrame, time: str = "time") -> DataFrame:
    return df.withColumn("date", F.to_date(time))


def min_observations(series: DataFrame, least: int, keys: list[str] = KEYS) -> DataFrame:
    """Series of ``least`` rows at least."""
    return series.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*keys))).where(F.col("__n") >= least).drop("__n")


def observed(series: DataFrame) -> DataFrame:
    return series.where(F.col("vi_count") > 0)


def clip_values(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.withColumn(column, F.when(F.col(column).isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), F.col(column)))))


def fill_missing(df: DataFrame, columns: list[str], fill: float) -> DataFrame:
    """The sentinel that raster files keep for null."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(fill)) for c in columns})


def unfill(df: DataFrame, columns: list[str], fill: float) -> DataFrame:
    """Nulls again for what is near the sentinel."""
    return df.withColumns({c: F.when(F.col(c) < 0.9 * fill, F.col(c)) for c in columns})
